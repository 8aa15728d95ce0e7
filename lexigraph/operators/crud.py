"""Keyed changes to snapshots: each gives the new rows and a report; nothing is changed in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def update_rows(rows: DataFrame, updates: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """Whole-row replacement by key; of several updates of a key the last by ``order`` holds, unknown keys have no effect.

    Every row with the key is replaced. Columns are those of ``rows``; a null key matches nothing.
    """
    rest = [c for c in rows.columns if c != key]
    value = F.struct(*rest)
    last = updates.where(F.col(key).isNotNull()).groupBy(key).agg((F.max_by(value, order) if order else F.any_value(value)).alias("__new"))
    return rows.join(last, key, "left").select(key, *(F.when(F.col("__new").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c) for c in rest)).select(*rows.columns)


def update_report(rows: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """``key, status`` of each update: 200, or 404 for unknown keys; bulk callers count both the input and the matches."""
    known = rows.select(key).distinct().withColumn("__known", F.lit(True))
    return updates.select(key).join(known, key, "left").select(key, F.when(F.col("__known"), 200).otherwise(404).alias("status"))


def insert_rows(rows: DataFrame, new: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """The rows with the new ones whose key is not in use, and ``key, status, n``: 201, 400 (no key), 409 (in use, or given
    more than once: the least row is inserted, the others are refused). Keys are counted before they are compared, so a key
    given any number of times is one row."""
    given = new.groupBy(key).agg(F.count("*").alias("n"), F.min(F.struct(*[c for c in rows.columns if c != key] or [key])).alias("__row"))
    known = rows.select(key).distinct().withColumn("__known", F.lit(True))
    judged = given.join(known, key, "left").withColumn("__status", F.when(F.coalesce(F.col(key).cast("string"), F.lit("")) == "", 400).when(F.col("__known"), 409).otherwise(201))
    fresh = judged.where("__status = 201").select(*(F.col(c) if c == key else F.col("__row")[c].alias(c) for c in rows.columns))
    each = F.when(F.col("__status") == 201, F.array(F.struct(F.lit(201).alias("status"), F.lit(1).cast("bigint").alias("n")), F.struct(F.lit(409).alias("status"), (F.col("n") - 1).alias("n")))).otherwise(F.array(F.struct(F.col("__status").alias("status"), F.col("n"))))
    report = judged.select(key, F.explode(each).alias("x")).where("x.n > 0").select(key, "x.status", "x.n")
    return rows.unionByName(fresh), report


def delete_first(rows: DataFrame, keys: DataFrame, key: str = "id", order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """The rows without the first one of each given key, and ``key, status``: 200, or 404 for unknown keys."""
    first = rows.groupBy(key).agg(F.min(order).alias(order))
    doomed = first.join(keys.select(key).distinct(), key, "left_semi")
    left = rows.join(doomed, [key, order], "left_anti")
    report = keys.select(key).distinct().join(doomed, key, "left").select(key, F.when(F.col(order).isNotNull(), 200).otherwise(404).alias("status"))
    return left.select(*rows.columns), report
