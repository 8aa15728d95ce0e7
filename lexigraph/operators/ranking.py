"""Row numbers and running totals within groups of any size, counted in two steps over range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def running(df: DataFrame, group: list[str], order: list[Column], amount: Column, out: str = "running") -> DataFrame:
    """``df`` with ``out``: the sum of ``amount`` over the rows of its group up to and with each row by ``order``, which should be
    total.

    Rows are range-partitioned by group and order, summed within their partition, and moved on by the sum of the same group
    in the partitions before: a group that holds a third of the rows is spread over a third of the tasks.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.withColumn("__amount", amount).repartitionByRange(parts, *map(F.col, group), *order).withColumn("__part", F.spark_partition_id()))
    local = placed.withColumn("__local", F.sum("__amount").over(Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sums = placed.groupBy("__part", *group).agg(F.sum("__amount").alias("__n"))
    before = sums.select("__part", *group, (F.sum("__n").over(Window.partitionBy(*group).orderBy("__part")) - F.col("__n")).alias("__before"))
    keys = [local["__part"] == before["__part"], *(local[g].eqNullSafe(before[g]) for g in group)]
    return local.join(before, keys).select(*(local[c] for c in df.columns), (F.col("__before") + F.col("__local")).cast("bigint").alias(out))


def ranked(df: DataFrame, group: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` with ``out``: the row number (from 1) of each row in its group by ``order``, which should be total."""
    return running(df, group, order, F.lit(1), out)
