"""Search history: the latest use of each query and mode, newest first, capped for each user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Entries kept.
KEPT = 20


def history(uses: DataFrame, user: str, what: list[str], at: str, tie: str, kept: int = KEPT) -> DataFrame:
    """``user, *what, at, rank``: each combination once, at its latest use. The combinations are made one row each by a
    combined aggregation before any user is ranked, and only the newest ones of a user reach the ranking."""
    latest = uses.groupBy(user, *what).agg(F.max(F.struct(at, tie)).alias("x")).select(user, *what, F.col(f"x.{at}").alias(at), F.col(f"x.{tie}").alias(tie))
    rank = F.row_number().over(Window.partitionBy(user).orderBy(F.desc(at), F.desc(tie)))
    return latest.withColumn("rank", rank).where(F.col("rank") <= kept)
