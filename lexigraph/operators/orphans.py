"""References to records that do not exist: co-partitioned, sorted, merged with the validity intervals of the parents.

References and parents are hash-partitioned by (table, key), sorted, and merged in one linear pass by a sort-merge join.
Of a parent key one row is kept: the interval from its first delivery to its removal, made by map-side combined
aggregation, so a key delivered any number of times weighs one row. A key that a third of all references point to makes
one large partition on the side of the references only, which adaptive execution splits; no side is ever broadcast by us.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def intervals(rows: DataFrame, removals: DataFrame, key: Column, removed_key: Column, order: str, *newest: str, loaded: str = "loaded_at", removed: str = "removed_at") -> DataFrame:
    """The validity interval of every key: ``key``, ``valid_from`` (first delivery), ``valid_to`` (its last removal if later
    than every delivery, else null: it is valid still), and the columns ``newest`` of its row with the highest ``order``, the
    one that refers.

    Null keys have no interval. Repeated deliveries and removals count once; a removal of an unknown key has no effect.
    """
    held = rows.select(key.alias("key"), F.col(loaded).alias("__at"), F.col(order).alias("__order"), F.struct(F.lit(0).alias("__"), *newest).alias("__row")).where("key is not null")
    seen = held.groupBy("key").agg(F.min("__at").alias("valid_from"), F.max("__at").alias("__last"), F.max_by("__row", "__order").alias("__row"))
    gone = removals.select(removed_key.alias("key"), F.col(removed).alias("__gone")).where("key is not null").groupBy("key").agg(F.max("__gone").alias("__gone"))
    valid_to = F.when(F.col("__gone") > F.coalesce("__last", F.lit("0001-01-01").cast("timestamp")), F.col("__gone"))
    return seen.join(gone, "key", "left").select("key", "valid_from", valid_to.alias("valid_to"), *(F.col("__row")[c].alias(c) for c in newest))


def orphans(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """The references whose target is missing, deleted or late, with ``reason`` and the ``valid_from`` of the target.

    ``refs``: ``target_table``, ``target_key``, ``ref_date`` (null: never late) and any other columns; ``parents``: ``table``,
    ``key``, ``valid_from``, ``valid_to``. A reference with a null target is none; repeated references are all returned; an
    empty ``parents`` makes every reference missing. A target delivered first on a later date than the reference is late.
    Columns ``reason`` and ``valid_from`` of ``refs`` itself are replaced.
    """
    p = parents.select(F.col("table").alias("__table"), F.col("key").alias("__key"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))
    refs = refs.drop("reason", "valid_from").where("target_key is not null")
    merged = refs.hint("merge").join(p, (F.col("target_table") == F.col("__table")) & (F.col("target_key") == F.col("__key")), "left")
    reason = (
        F.when(F.col("__key").isNull(), "missing")
        .when(F.col("__to").isNotNull(), "deleted")
        .when(F.to_date("__from") > F.col("ref_date"), "late")
    )
    return merged.select(*refs.columns, F.col("__from").alias("valid_from"), reason.alias("reason")).where("reason is not null")


def by_table_and_month(found: DataFrame) -> DataFrame:
    """Orphans counted by table of the reference, month of the reference (null: no date) and reason."""
    return found.groupBy("src_table", F.trunc("ref_date", "month").alias("month"), "reason").agg(F.count("*").alias("n"))
