"""Lookups over a lexicon: point, nearest key, prefix, reference with word boundaries; single and in batches.

A batch form takes a DataFrame of queries. Prefix batches are equi-joins on the prefixes of the lengths in use, never
nested loops; nearest keys come from one range-partitioned merge of keys and queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import normalize_hebrew, normalize_reference
from ..session import cut
from .index import representative


def by_id(entries: DataFrame, ids: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """The row of each id in ``ids``; of an id on several rows the last. Ids without a row give none."""
    wanted = entries.join(ids.select(key).where(F.col(key) != "").distinct(), key, "left_semi")
    return wanted.groupBy(key).agg(F.max_by(F.struct("*"), order).alias("x")).select("x.*")


def ordinal(entries: DataFrame, ids: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Each id of ``ids`` with the ordinal of its last row, or -1."""
    last = entries.groupBy(key).agg(F.max(order).alias("ordinal"))
    return ids.select(key).distinct().join(last, key, "left").select(key, F.coalesce("ordinal", F.lit(-1)).alias("ordinal"))


def prefix_headwords(entries: DataFrame, query: str, limit: int = 8) -> DataFrame:
    """The first ``limit`` keys that begin with the letters of the query, with the headword of their first row. A query
    without Hebrew letters finds nothing."""
    q = normalize_hebrew(F.lit(query))
    keys = representative(entries.where((q != "") & F.col("norm").startswith(q)))
    return keys.orderBy("norm").limit(limit)


def prefix_headwords_batch(entries: DataFrame, queries: DataFrame, query: str = "query", limit: int = 8) -> DataFrame:
    """``prefix_headwords`` for every query: ``query, rank, norm, hw``."""
    asked = queries.select(query).distinct().withColumn("__q", normalize_hebrew(F.col(query))).where("__q <> ''")
    return _by_prefix(representative(entries), asked, query, "norm", limit, ["norm"]).select(query, "rank", "norm", "hw")


def prefix_references(references: DataFrame, query: str, limit: int = 8) -> DataFrame:
    """The first ``limit`` references (as of ``sorted_references``) whose normal form begins with that of the query."""
    q = normalize_reference(F.lit(query))
    return references.where((q != "") & F.col("norm").startswith(q)).orderBy("norm", "first_seq", "first_pos", "ref").limit(limit)


def prefix_references_batch(references: DataFrame, queries: DataFrame, query: str = "query", limit: int = 8) -> DataFrame:
    asked = queries.select(query).distinct().withColumn("__q", normalize_reference(F.col(query))).where("__q <> ''")
    return _by_prefix(references, asked, query, "norm", limit, ["norm", "first_seq", "first_pos", "ref"]).select(query, "rank", "norm", "ref")


def _by_prefix(keys: DataFrame, asked: DataFrame, query: str, key: str, limit: int, order: list[str]) -> DataFrame:
    """The first keys of each query: keys are exploded into their prefixes of the lengths in use and met by equality."""
    lengths = F.broadcast(asked.agg(F.collect_set(F.length("__q")).alias("__lengths")))  # one row of a few numbers
    heads = keys.join(lengths).select("*", F.explode(F.filter("__lengths", lambda n: n <= F.length(key))).alias("__n"))
    met = heads.withColumn("__q", F.expr(f"left({key}, __n)")).join(asked, "__q")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(*order)))
    return ranked.where(F.col("rank") <= limit)


def nearest(entries: DataFrame, query: str) -> DataFrame:
    """The rows of the key equal to the query, else of the first key after it, else of the last key."""
    q = normalize_hebrew(F.lit(query))
    after = entries.where(F.col("norm") >= q).agg(F.min("norm").alias("a"), F.lit(None).cast("string").alias("z"))  # pushed down where stored
    last = entries.agg(F.lit(None).cast("string").alias("a"), F.max("norm").alias("z"))
    key = after.unionByName(last).agg(F.coalesce(F.max("a"), F.max("z")).alias("norm"))
    return entries.join(F.broadcast(key), "norm", "left_semi")


def nearest_batch(entries: DataFrame, queries: DataFrame, query: str = "query", key: str = "norm") -> DataFrame:
    """Each distinct query with the key that ``nearest`` finds: ``query, key`` (null if there are no keys).

    Keys and queries are range-partitioned together and sorted; within a partition the next key is carried back over the
    queries before it, and what a partition lacks comes from the first key of the partitions after it (one row each).
    """
    asked = queries.select(F.col(query).alias("__query")).distinct().withColumn("k", normalize_hebrew(F.col("__query")))
    both = entries.select(F.col(key).alias("k")).distinct().select(F.lit(None).cast("string").alias("__query"), "k", F.lit(1).alias("is_key")).unionByName(asked.withColumn("is_key", F.lit(0)))
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = cut(both.repartitionByRange(parts, "k").withColumn("part", F.spark_partition_id()))
    after = Window.partitionBy("part").orderBy("k", "is_key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    local = both.withColumn("next", F.first(F.when(F.col("is_key") == 1, F.col("k")), ignorenulls=True).over(after)).where("is_key = 0")
    heads = both.groupBy("part").agg(F.min(F.when(F.col("is_key") == 1, F.col("k"))).alias("head"), F.max(F.when(F.col("is_key") == 1, F.col("k"))).alias("tail"))
    later = Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)  # as many rows as partitions
    whole = Window.partitionBy(F.lit(0))
    heads = heads.select("part", F.first("head", ignorenulls=True).over(later).alias("later"), F.max("tail").over(whole).alias("last"))
    return local.join(F.broadcast(heads), "part").select(F.col("__query").alias(query), F.coalesce("next", "later", "last").alias("key"))


def at_boundary(norm: Column, q: Column) -> Column:
    """Whether a normal form begins with ``q`` and goes on with nothing, a colon or a space."""
    return norm.startswith(q) & ((F.length(norm) == F.length(q)) | F.substring(norm, F.length(q) + 1, F.lit(1)).isin(":", " "))


def by_reference(entries: DataFrame, refs: DataFrame, query: str) -> DataFrame:
    """The entries with a reference that the query is a whole beginning of, each once, in file order. An empty query finds
    nothing."""
    q = normalize_reference(F.lit(query))
    hits = refs.where((q != "") & at_boundary(F.col("norm"), q)).select("seq").distinct()
    return entries.join(hits, "seq", "left_semi").orderBy("seq")


def by_reference_batch(refs: DataFrame, queries: DataFrame, query: str = "query") -> DataFrame:
    """``query, seq`` of the entries that ``by_reference`` finds for every query: references are exploded into their whole
    beginnings (before each colon or space, and the whole) and met by equality."""
    asked = queries.select(query).distinct().withColumn("__q", normalize_reference(F.col(query))).where("__q <> ''")
    # A beginning is whole where a colon or a space follows it.
    stops = F.filter(F.sequence(F.lit(1), F.length("norm")), lambda i: (i == F.length("norm")) | F.substring(F.col("norm"), i + 1, F.lit(1)).isin(":", " "))
    heads = refs.where("norm <> ''").select("seq", "norm", F.explode(stops).alias("n")).select("seq", F.expr("left(norm, n)").alias("__q")).distinct()
    return heads.join(asked, "__q").select(query, "seq").distinct()


def best_match(rows: DataFrame, term: str, text: str, order: str, query: str) -> DataFrame:
    """The best row for a query: a term that begins with it, else one that contains it, else a text that contains it; the
    first in display order. A blank query finds nothing."""
    q = F.lower(F.trim(F.lit(query)))
    tier = F.when(F.lower(term).startswith(q), 1).when(F.contains(F.lower(F.col(term)), q), 2).when(F.contains(F.lower(F.col(text)), q), 3)
    return rows.withColumn("tier", tier).where((q != "") & F.col("tier").isNotNull()).orderBy("tier", order).limit(1)


def capped(rows: DataFrame, order: str, shown: int = 50, skip: int = 0) -> tuple[DataFrame, DataFrame]:
    """A page of at most ``shown`` rows in order, and one row ``total, remaining`` (rows after this page)."""
    page = rows.orderBy(order).offset(skip).limit(shown)
    rest = rows.agg(F.count("*").alias("total")).withColumn("remaining", F.greatest(F.col("total") - shown - skip, F.lit(0)))
    return page, rest
