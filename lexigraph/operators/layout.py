"""The layout of the graph: bands by era, generation and location; rows, columns and positions; years to heights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.display import curve
from .graph import visible, visible_edges
from .ranking import ranked

#: Sizes of the drawing.
NODE_W, NODE_H, GAP, PER_ROW, ROW_H, COLUMN_GAP, LEAST_COLUMN = 140, 44, 12, 5, 70, 40, 300
TOP, RIGHT, BOTTOM, LEFT, BETWEEN = 40, 30, 30, 30, 8
#: The rows, and the year at which each begins.
ROWS = [("tanna", g) for g in range(1, 6)] + [("amorai", g) for g in range(1, 8)]
YEARS = [-50, 30, 70, 130, 170, 220, 260, 290, 320, 350, 390, 430]


def row_table(spark: SparkSession) -> DataFrame:
    """The twelve rows from top to bottom: ``era, generation, row, year``."""
    return spark.createDataFrame([(e, g, i, y) for i, ((e, g), y) in enumerate(zip(ROWS, YEARS))], "era string, generation int, row int, year int")


def bands(sages: DataFrame) -> DataFrame:
    """Number of nodes in each band."""
    return sages.groupBy("era", "generation", "location").agg(F.count("*").alias("n"))


def row_heights(nodes: DataFrame) -> DataFrame:
    """``era, generation, row, year, y``: each row begins below those before it, which are as high as their fuller side needs."""
    side = lambda x: F.coalesce(F.max(F.when(F.col("location") == x, F.col("n"))), F.lit(0))
    full = bands(nodes).groupBy("era", "generation").agg(F.greatest(side("israel"), side("bavel"), F.lit(1)).alias("most"))
    rows = row_table(nodes.sparkSession).join(full, ["era", "generation"], "left").fillna(1, ["most"])
    height = F.greatest(F.lit(ROW_H), F.ceil(F.col("most") / PER_ROW) * (NODE_H + GAP)) + BETWEEN
    above = Window.orderBy("row").rowsBetween(Window.unboundedPreceding, -1)  # twelve rows
    return rows.select("era", "generation", "row", "year", (TOP + F.coalesce(F.sum(height).over(above), F.lit(0))).cast("bigint").alias("y"), height.cast("bigint").alias("height"))


def columns(nodes: DataFrame) -> DataFrame:
    """One row: ``bavel_x, israel_x, total_width``; each column is as wide as its widest band, five nodes at most."""
    wide = lambda x: F.greatest(F.coalesce(F.max(F.when(F.col("location") == x, F.least("n", F.lit(PER_ROW)))), F.lit(1)) * (NODE_W + GAP), F.lit(LEAST_COLUMN))
    w = bands(nodes).agg(wide("bavel").alias("bavel"), wide("israel").alias("israel"))
    israel_x = LEFT + F.col("bavel") + COLUMN_GAP
    return w.select(F.lit(LEFT).cast("bigint").alias("bavel_x"), israel_x.cast("bigint").alias("israel_x"), (israel_x + F.col("israel") + RIGHT).cast("bigint").alias("total_width"))


def positions(sages: DataFrame, groups: Sequence[str] = ("tanna",)) -> DataFrame:
    """``id, era, generation, location, rank, x, y`` of the visible nodes that have a row and a column.

    Within a band nodes go by year of birth (missing: 0), then name, then id, five to a line. The positions are computed
    anew for each filter: nodes that are not visible have none.
    """
    nodes = visible(sages, groups).select("id", "era", "generation", "location", F.coalesce("dates.born", F.lit(0)).alias("born"), F.coalesce("name.en", F.lit("")).alias("en"))
    placed = ranked(nodes, ["era", "generation", "location"], [F.col("born"), F.col("en"), F.col("id")])
    rows, cols = row_heights(nodes), columns(nodes)
    i = F.col("rank") - 1
    x = F.when(F.col("location") == "bavel", F.col("bavel_x")).when(F.col("location") == "israel", F.col("israel_x")) + (i % PER_ROW) * (NODE_W + GAP)
    y = F.col("y") + F.floor(i / PER_ROW) * (NODE_H + GAP)
    met = placed.join(F.broadcast(rows.select("era", "generation", "y")), ["era", "generation"]).join(F.broadcast(cols))  # twelve rows, one row
    return met.where(F.col("location").isin("bavel", "israel")).select("id", "era", "generation", "location", "rank", x.cast("bigint").alias("x"), y.cast("bigint").alias("y"))


def bounding_box(placed: DataFrame) -> DataFrame:
    """One row ``min_x, min_y, max_x, max_y`` around the nodes; no row if there are none."""
    return placed.agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), (F.max("x") + NODE_W).alias("max_x"), (F.max("y") + NODE_H).alias("max_y")).where("min_x is not null")


def initial_view(placed: DataFrame, view_w: float) -> DataFrame:
    """``scale, tx, ty``: wide enough for the nodes, at most 0.72, from the top."""
    box = bounding_box(placed)
    scale = F.least(view_w / (F.col("max_x") - F.col("min_x") + 40), F.lit(0.8)) * 0.9
    return box.select(scale.alias("scale"), (view_w / 2 - (F.col("min_x") + F.col("max_x")) / 2 * scale).alias("tx"), (20 - F.col("min_y") * scale).alias("ty"))


def centred(placed: DataFrame, node: str, view_w: float, view_h: float, scale: float = 1.0) -> DataFrame:
    """``id, tx, ty`` that bring a node to the middle of the view; no row for an unknown one."""
    return placed.where(F.col("id") == node).select("id", (view_w / 2 - (F.col("x") + NODE_W / 2) * scale).alias("tx"), (view_h / 2 - (F.col("y") + NODE_H / 2) * scale).alias("ty"))


def edge_curves(sages: DataFrame, groups: Sequence[str] = ("tanna",)) -> DataFrame:
    """The curves of the visible edges whose ends both have a position."""
    p = positions(sages, groups)
    a = p.select(F.col("id").alias("src"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    b = p.select(F.col("id").alias("dst"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    met = visible_edges(sages, groups).select("src", "dst", "type").join(a, "src").join(b, "dst")
    return met.select("src", "dst", "type", curve(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), NODE_W, NODE_H).alias("c")).select("src", "dst", "type", "c.*")


def year_heights(years: DataFrame, heights: DataFrame, year: str = "year", strict: bool = False) -> DataFrame:
    """``years`` with ``at``: the height of a year, linear between the rows before and after; null outside their years.

    With ``strict`` every height is null, as where a drawing finds no row for any year.
    """
    after = Window.orderBy("row")  # twelve rows
    spans = heights.select(F.col("year").alias("__a"), F.lead("year").over(after).alias("__b"), F.col("y").alias("__y"), F.lead("y").over(after).alias("__z")).where("__b is not null")
    met = years.join(F.broadcast(spans), (F.col(year) >= F.col("__a")) & (F.col(year) < F.col("__b")), "left")
    share = (F.col(year) - F.col("__a")) / (F.col("__b") - F.col("__a"))
    at: Column = F.lit(None).cast("double") if strict else F.col("__y") + share * (F.col("__z") - F.col("__y"))
    return met.select(*years.columns, at.alias("at"))
