"""Missing values filled from the statistics of similar records, backing off from fine to coarse groups.

The values are counted per (level, group, field, value) with map-side combine, so a group of any size reaches the shuffle as
its distinct values. The mode is the value of the greatest count; the median of a numeric field is exact, from running
totals of the counts in the order of the values, which are summed over range partitions in two steps. Only records that
lack a value are joined with the statistics; a group that holds a third of the records is split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import running


@dataclass(frozen=True)
class Field:
    """A field to fill: ``value`` is its reading (null: missing). ``numeric`` fields take the (lower) median of the group, others
    the mode (ties: the smallest value). ``when`` may forbid filling, given the filled readings of the fields before it."""

    name: str
    value: Column
    numeric: bool = False
    when: Callable[[dict[str, Column]], Column] | None = None


def group_statistics(df: DataFrame, levels: Sequence[Column], fields: Sequence[Field]) -> DataFrame:
    """``__level, __group``, and of each field its statistic ``s_<i>`` (as text) and support ``n_<i>`` (number of values in the
    group). Rows whose group is null or '' belong to no group of that level."""
    held = [F.struct(F.lit(i).alias("f"), f.value.cast("string").alias("v"), (f.value.cast("double") if f.numeric else F.lit(None).cast("double")).alias("x")) for i, f in enumerate(fields)]
    places = [F.struct(F.lit(i).alias("l"), c.cast("string").alias("g")) for i, c in enumerate(levels)]
    long = df.select(F.filter(F.array(*places), lambda x: x.g != "").alias("p"), F.filter(F.array(*held), lambda x: x.v.isNotNull()).alias("h")).where((F.size("p") > 0) & (F.size("h") > 0))
    long = long.select(F.explode("p").alias("p"), "h").select("p", F.explode("h").alias("h")).select(F.col("p.l").alias("__level"), F.col("p.g").alias("__group"), "h.*")
    at, of = ["__level", "__group"], ["__level", "__group", "f"]
    counted = long.groupBy(*of, "v", "x").agg(F.count("*").alias("n"))
    numbers = [i for i, f in enumerate(fields) if f.numeric]
    found = counted.where(~F.col("f").isin(*numbers)).groupBy(*of).agg(F.expr("min_by(v, struct(-n, v))").alias("s"), F.sum("n").alias("n"))
    if numbers:
        upto = running(counted.where(F.col("f").isin(*numbers)), of, [F.col("x"), F.col("v")], F.col("n"))
        total = upto.groupBy(*of).agg(F.max("running").alias("total"))
        middle = upto.join(total, of).where(F.col("running") * 2 >= F.col("total"))
        found = found.unionByName(middle.groupBy(*of).agg(F.min_by("v", "running").alias("s"), F.max("total").alias("n")))
    columns = [y for i in range(len(fields)) for y in (F.max(F.when(F.col("f") == i, F.col("s"))).alias(f"s_{i}"), F.coalesce(F.max(F.when(F.col("f") == i, F.col("n"))), F.lit(0)).alias(f"n_{i}"))]
    return found.groupBy(*at).agg(*columns)


def _filled(df: DataFrame, levels: Sequence[Column], fields: Sequence[Field], min_support: int) -> tuple[DataFrame, DataFrame]:
    """The rows that lack a value, and the others, with ``<name>_value`` and ``<name>_level`` of each field."""
    df = df.drop(*(f"{f.name}_{x}" for f in fields for x in ("value", "level")))
    stats = group_statistics(df, levels, fields)
    types = [t.dataType for t in df.select(*(f.value.alias(str(i)) for i, f in enumerate(fields))).schema]
    read = df.select("*", *(f.value.alias(f"__v{i}") for i, f in enumerate(fields)), *(c.cast("string").alias(f"__g{i}") for i, c in enumerate(levels)))
    lacking = F.lit(False)
    for i in range(len(fields)):
        lacking = lacking | F.col(f"__v{i}").isNull()
    rows = read.where(lacking)
    for j in range(len(levels)):
        s = stats.where(F.col("__level") == j).select(F.col("__group").alias(f"__k{j}"), *(F.col(f"{x}_{i}").alias(f"__{x}{i}_{j}") for i in range(len(fields)) for x in "sn"))
        rows = rows.join(s, F.col(f"__g{j}") == F.col(f"__k{j}"), "left")
    out: dict[str, Column] = {}
    columns = []
    for i, f in enumerate(fields):
        level = F.coalesce(*(F.when(F.col(f"__n{i}_{j}") >= min_support, F.lit(j)) for j in range(len(levels))))
        value = F.coalesce(*(F.when(F.col(f"__n{i}_{j}") >= min_support, F.col(f"__s{i}_{j}")) for j in range(len(levels))))
        open_ = F.col(f"__v{i}").isNull() & (F.coalesce(f.when(out), F.lit(False)) if f.when else F.lit(True))
        out[f.name] = F.coalesce(F.col(f"__v{i}"), F.when(open_, value.cast(types[i])))
        columns += [out[f.name].alias(f"{f.name}_value"), F.when(open_, level).alias(f"{f.name}_level")]
    whole = read.where(~lacking).select(*df.columns, *(x for i, f in enumerate(fields) for x in (F.col(f"__v{i}").alias(f"{f.name}_value"), F.lit(None).cast("int").alias(f"{f.name}_level"))))
    return rows.select(*df.columns, *columns), whole


def fill_from_groups(df: DataFrame, levels: Sequence[Column], fields: Sequence[Field], min_support: int = 1) -> DataFrame:
    """``df`` with, for each field, ``<name>_value`` (its reading or what was filled in, of the type of the reading) and
    ``<name>_level``: null if it was not filled, else the number of the level (0: the finest) that it was filled from.

    ``levels`` are group keys from fine to coarse; the first whose group holds at least ``min_support`` values of the field
    gives the value. Rows without any group, and fields for which no level has enough support, stay null with a null level.
    Columns of ``df`` with the names of those added are replaced. An empty ``df`` gives an empty result.
    """
    rows, whole = _filled(df, levels, fields, min_support)
    return rows.unionByName(whole)


def filled_values(df: DataFrame, key: str, levels: Sequence[Column], fields: Sequence[Field], min_support: int = 1) -> DataFrame:
    """Only what was filled: ``key, field, value`` (as text) and ``level``. Rows that lack nothing are not read again."""
    rows, _ = _filled(df, levels, fields, min_support)
    cases = F.array(*(F.struct(F.lit(f.name).alias("field"), F.col(f"{f.name}_value").cast("string").alias("value"), F.col(f"{f.name}_level").alias("level")) for f in fields))
    return rows.select(key, F.explode(cases).alias("x")).select(key, "x.*").where("level is not null")
