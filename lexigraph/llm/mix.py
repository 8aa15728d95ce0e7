"""Sources mixed to target weights by positions on a training schedule.

The weight of each source may vary over the run, as a piecewise linear function of the position from 0 to 1. Its integral is
the cumulative demand of tokens; inverting it gives the position at which each text of the source is due, and sorting all
texts by position gives the corpus. A source that cannot reach its weight runs out before the end of the run. The place of a text within its source is a prefix sum of tokens in hashed order, taken
in two steps (sums of buckets, then within buckets), so that a source of any size is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import trim_all
from ..session import bounded, cut
from .encode import count_tokens

#: Rows of a bucket of a source, about; most rows of the targets for which they are broadcast.
BUCKET_ROWS, BROADCAST_ROWS = 20_000, 10_000


def source_key(c: Column) -> Column:
    """A source name without regard to case, surrounding blanks, hyphens and underscores."""
    return F.regexp_replace(F.lower(trim_all(c)), "[-_]", "")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if bounded(df, BROADCAST_ROWS) else df


def sized(docs: DataFrame, targets: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", path: str | None = None) -> DataFrame:
    """The documents of listed sources: ``doc_id, source`` (as in the targets), ``n_tokens`` and ``digest`` of the text."""
    listed = targets.select(F.col("source").alias("__source"), source_key(F.col("source")).alias("__key"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("__name"), F.col(text_col).alias("__body"))
    mine = rows.join(_small(listed), source_key(F.col("__name")) == F.col("__key"))
    mine = mine.select("doc_id", F.col("__source").alias("source"), F.sha2("__body", 256).alias("digest"), "__body")
    return count_tokens(mine, "__body", "doc_id", "source", "digest", path=path)


def supply(texts: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each target: ``source, weight, max_repeats, n_docs, tokens``, ``total`` (tokens of all sources), ``wanted`` (weight
    times total) and ``reached`` (whether tokens times max_repeats suffice). A source without documents has 0 tokens."""
    sums = texts.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    own = targets.select("source", "weight", "max_repeats").join(sums, "source", "left").fillna(0, ["n_docs", "tokens"])
    all_ = own.withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(0))))  # as many rows as targets
    return all_.withColumn("wanted", F.col("weight") * F.col("total")).withColumn("reached", F.col("tokens") * F.col("max_repeats") >= F.col("wanted"))


def _knots(schedule: Mapping[str, Sequence[tuple[float, float]]]) -> dict[str, tuple[list[float], list[float], list[float]]]:
    """Of each source the places, rates and cumulated rates of its schedule, the whole brought to 1."""
    out = {}
    for source, points in schedule.items():
        u, w = [float(p[0]) for p in points], [float(p[1]) for p in points]
        if u[0] != 0 or u[-1] != 1 or sorted(set(u)) != u or min(w) <= 0:
            raise ValueError(f"the schedule of {source} must run from 0 to 1 with positive rates")
        c = [0.0]
        for i in range(len(u) - 1):
            c.append(c[-1] + (u[i + 1] - u[i]) * (w[i] + w[i + 1]) / 2)
        out[source] = (u, [x / c[-1] for x in w], [x / c[-1] for x in c])
    return out


def _position(q: Column, u: Column, w: Column, c: Column) -> Column:
    """The position at which the share ``q`` of a source is due: the cumulative rate inverted, segment by segment."""
    i = F.least(F.size(F.filter(c, lambda x: x <= q)), F.size(c) - 1)
    u0, u1, w0, w1, left = F.element_at(u, i), F.element_at(u, i + 1), F.element_at(w, i), F.element_at(w, i + 1), q - F.element_at(c, i)
    slope = (w1 - w0) / (u1 - u0)
    return F.least(u0 + 2 * left / (w0 + F.sqrt(F.greatest(w0 * w0 + 2 * slope * left, F.lit(0.0)))), F.lit(1.0))


def mix(docs: DataFrame, targets: DataFrame, schedule: Mapping[str, Sequence[tuple[float, float]]] | None = None, path: str | None = None, columns: Mapping[str, str] | None = None, every: bool = False) -> DataFrame:
    """The corpus, sorted: ``position`` (0 to 1), ``doc_id, source, copy`` (0 for the first use), ``n_tokens``, and the tokens that
    its source is asked for (``wanted``) and has given up to and with this text (``given``).

    Of every text one document is used (of exact copies the smallest doc_id, with its source), so that no text is used more
    than ``max_repeats`` times; with ``every`` each document counts for itself. A source is used until its weight of the size of
    all listed documents is reached, or, where it cannot reach it, as often as allowed; its texts then end before the run
    does. ``schedule`` gives for some sources (place, rate) points from 0 to 1; the others are spread evenly. The share of a
    source over the whole run does not depend on its schedule.

    Defined cases: null, empty and unlisted sources, null and empty texts are left out; no documents give an empty corpus;
    the order within a source is that of a hash of the text, so it does not depend on the input order; null weights and
    repeats count as 0.
    """
    texts = _placed(docs, targets, path, columns, every)
    knots = _knots(schedule or {})
    flat = ([0.0, 1.0], [1.0, 1.0], [0.0, 1.0])
    choose = lambda k: F.coalesce(*(F.when(F.col("source") == s, F.array(*map(F.lit, v[k]))) for s, v in knots.items()), F.array(*map(F.lit, flat[k])))
    due = (F.col("begin") + F.col("copy") * F.col("tokens")) / F.col("wanted")
    demand = F.least("wanted", F.col("tokens") * F.col("max_repeats"))
    copies = F.sequence(F.lit(0), F.ceil((demand - F.col("begin")) / F.col("tokens")).cast("int") - 1)
    used = texts.where(F.col("begin") < demand).withColumn("copy", F.explode(copies))
    given = F.col("begin") + F.col("copy") * F.col("tokens") + F.col("n_tokens")
    return used.select(_position(due, choose(0), choose(1), choose(2)).alias("position"), "doc_id", "source", "copy", "n_tokens", "wanted", given.alias("given")).orderBy("position", "source", "doc_id")


def _placed(docs: DataFrame, targets: DataFrame, path: str | None, columns: Mapping[str, str] | None, every: bool) -> DataFrame:
    """The documents used, with the tokens of their source before them (``begin``) and the numbers of the source."""
    all_ = cut(sized(docs, targets, path=path, **(columns or {})))
    texts = all_.where("n_tokens > 0").select("doc_id", "source", "n_tokens", F.xxhash64("digest").alias("h"), "digest")
    if not every:
        texts = texts.groupBy("digest").agg(F.min(F.struct("doc_id", "source", "n_tokens", "h")).alias("x")).select("x.*")
    wanted = supply(all_, targets).select("source", F.coalesce("wanted", F.lit(0.0)).alias("wanted"))
    sums = texts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), (1 + F.floor(F.count("*") / BUCKET_ROWS)).alias("buckets"))
    plan = sums.join(wanted, "source").join(targets.select("source", F.coalesce("max_repeats", F.lit(0)).alias("max_repeats")), "source")
    rows = texts.drop("digest").join(_small(plan), "source").withColumn("bucket", F.pmod("h", "buckets"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("__sum"))
    before = sums.select("source", "bucket", (F.sum("__sum").over(Window.partitionBy("source").orderBy("bucket")) - F.col("__sum")).alias("__before"))
    order = Window.partitionBy("source", "bucket").orderBy("h", "doc_id")
    return rows.join(before, ["source", "bucket"]).withColumn("begin", F.col("__before") + F.sum("n_tokens").over(order) - F.col("n_tokens"))


def short_sources(corpus: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets whose texts end before the run does: ``source, wanted, given``. A source with a weight but without a text in
    the corpus is short too, where the corpus holds any."""
    ends = corpus.groupBy("source").agg(F.max("given").alias("given"), F.max("wanted").alias("wanted"))
    any_ = ends.agg(F.count("*").alias("__n"))  # one row
    own = targets.select("source", "weight").join(ends, "source", "left").join(F.broadcast(any_))
    return own.where("coalesce(given < wanted, weight > 0 and __n > 0)").select("source", "wanted", F.coalesce("given", F.lit(0)).alias("given"))


def shares(corpus: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each target: its weight, the uses, texts and tokens in the corpus, the share reached and the most uses of a text."""
    uses = corpus.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("n_tokens").alias("tokens"))
    sums = uses.groupBy("source").agg(F.sum("uses").alias("uses"), F.count("*").alias("texts"), F.sum("tokens").alias("tokens"), F.max("uses").alias("most_uses"))
    own = targets.select("source", "weight").join(sums, "source", "left").fillna(0, ["uses", "texts", "tokens", "most_uses"])
    return own.withColumn("share", F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy(F.lit(0))), F.lit(0)))
