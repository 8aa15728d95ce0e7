"""Derived tables in place of in-memory indexes: keys with their rows, references, neighbours; stored sorted for range reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import normalize_hebrew, normalize_reference

#: Rows of file order that one task handles when neighbours are looked up.
SPAN = 1_000_000


def page_of(p: Column) -> Column:
    """The printed page of a text; null for 0 and for what is no plain number."""
    return F.nullif(F.regexp_extract(F.coalesce(p, F.lit("")), r"^\s*([0-9]+)\s*$", 1).try_cast("int"), F.lit(0))


def with_keys(entries: DataFrame) -> DataFrame:
    """Entries with ``norm`` (key of the headword; null headwords have '') and ``page`` (printed page; 0 and others null)."""
    return entries.withColumn("norm", normalize_hebrew(F.col("hw"))).withColumn("page", page_of(F.col("p")))


def entry_refs(entries: DataFrame) -> DataFrame:
    """All references: ``seq, category, pos, ref, norm``; repeated references stay, null ones go."""
    each = entries.select("seq", F.explode("rf").alias("category", "refs")).select("seq", "category", F.posexplode("refs").alias("pos", "ref"))
    return each.where("ref is not null").withColumn("norm", normalize_reference(F.col("ref")))


def store_keyed(entries: DataFrame, path: str) -> None:
    """Write entries with their keys, range-partitioned and sorted by key: a prefix or range of the stored column ``norm`` then
    reaches the parquet scan as a pushed filter and skips row groups."""
    keyed = entries if "norm" in entries.columns else with_keys(entries)
    keyed.repartitionByRange("norm", "seq").sortWithinPartitions("norm", "seq").write.mode("overwrite").parquet(path)


def key_index(rows: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """Of each key: number of rows, first and last in file order. Map-side combined, so a key of any size is one row."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))


def key_rows(rows: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The rows under each key, as (key, seq), sorted: the flat form of an index, which a range read on the key prunes."""
    return rows.where(F.col(key).isNotNull()).select(key, order).sort(key, order)


def representative(rows: DataFrame, key: str = "norm", value: str = "hw", order: str = "seq") -> DataFrame:
    """Of each key the value of its first row."""
    return rows.groupBy(key).agg(F.min_by(value, order).alias(value), F.min(order).alias(order))


def sorted_references(refs: DataFrame) -> DataFrame:
    """Distinct references with their first place, sorted by normal form, ties in first-seen order."""
    first = refs.groupBy("ref", "norm").agg(F.min(F.struct("seq", "category", "pos")).alias("x"))
    return first.select("ref", "norm", F.col("x.seq").alias("first_seq"), F.col("x.pos").alias("first_pos")).sort("norm", "first_seq", "first_pos", "ref")


def neighbours(rows: DataFrame, value: str = "hw", order: str = "seq") -> DataFrame:
    """Previous and next value in file order: ``order, prev, next``. The dense ordinals are cut into spans; the row at each
    edge is lent to the span beside it, so no task sees more than a span."""
    span = F.floor(F.col(order) / SPAN)
    spans = F.array_distinct(F.array(span, F.floor((F.col(order) - 1) / SPAN), F.floor((F.col(order) + 1) / SPAN)))
    lent = rows.select(order, F.col(value).alias("__v"), span.alias("__own"), F.explode(spans).alias("__span"))
    w = Window.partitionBy("__span").orderBy(order)
    return lent.select(order, F.lag("__v").over(w).alias("prev"), F.lead("__v").over(w).alias("next"), (F.col("__own") == F.col("__span")).alias("__mine")).where("__mine").drop("__mine")
