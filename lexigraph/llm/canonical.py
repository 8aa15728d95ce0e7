"""Freely typed values mapped to a reference list by a prefix-filtered set-similarity join.

Every distinct spelling is a set of letter triples, the letters of a triple in alphabetical order, so that two letters that
changed places spoil as few of them as one wrong letter. The edits that are allowed for a length bound how many triples of
two texts must be shared, and so the Jaccard similarity that is asked for. Triples are ordered by how rare they are over all
values and the list; texts as similar as that share at least two of their rarest triples, so only these prefixes are joined.
Joined triples pass a length filter and two positional filters (place in the text, place in the set); for what is left the
edit distance decides, the Jaccard similarity is computed exactly, and the best form is kept. Values are brought to their
distinct forms first, so a value typed a billion times is compared once.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import WS
from ..session import cut


def _plain_letters() -> tuple[str, str]:
    """Latin letters with marks, full-width and raised ones, and the one letter they decompose to."""
    table = {}
    for code in [*range(0xC0, 0x250), *range(0x1D2C, 0x1DC0), *range(0x1E00, 0x1F00), *range(0x2070, 0x20A0), *range(0xFF01, 0xFF5F)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) == 1 and base != chr(code):
            table[chr(code)] = base
    return "".join(table), "".join(table.values())


MARKED, UNMARKED = _plain_letters()


def plain(c: Column) -> Column:
    """Lower-case text without tags, entities and marks on letters; other signs stay; white space is one space."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&#39;", "'"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    c = F.lower(F.regexp_replace(F.translate(c, MARKED + "’", UNMARKED + "'"), r"\p{M}+", ""))
    return F.trim(F.regexp_replace(c, f"[{WS}]+", " "))


def letters(c: Column) -> Column:
    """Only letters and digits."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}]+", "")


def words(c: Column) -> Column:
    """Letters and digits of the words, one space between them; apostrophes part no words."""
    return F.trim(F.regexp_replace(F.replace(c, F.lit("'"), F.lit("")), r"[^\p{L}\p{N}]+", " "))


def sound(c: Column) -> Column:
    """Words with digits read as the letters they resemble and spellings of one sound as one; doubled letters as one."""
    c = F.translate(words(c), "018qcjw", "olbkkyv")
    for several, one in (("ee", "i"), ("oo", "u"), ("ph", "f"), ("ts", "tz")):
        c = F.replace(c, F.lit(several), F.lit(one))
    return F.regexp_replace(c, r"(\p{L})\1+", "$1")


def edits_between(a: Column, b: Column) -> Column:
    """The mean of the edit distance and the letters not shared: as an edit distance in which two letters that changed
    places are one edit."""
    count = lambda s, x: F.length(s) - F.length(F.replace(s, x, F.lit("")))
    shared = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, x: n + F.when(x == "", 0).otherwise(F.least(count(a, x), count(b, x))))
    return (F.levenshtein(a, b) + F.greatest(F.length(a), F.length(b)) - shared) / 2


def _forms(names: DataFrame, name_col: str, key_col: str | None, shortest: int) -> DataFrame:
    """All forms of a list: ``form, target, grade`` (0 names, 1 keys, 2 names cut short) with their ``letters``."""
    full = plain(F.col(name_col))
    name = names.where(F.col(name_col).isNotNull()).select(full.alias("form"), F.col(name_col).alias("target"), F.lit(0).alias("grade"))
    last = F.length(F.substring_index(full, " ", -1))
    cut_short = names.where((last > shortest)).select(F.explode(F.sequence(F.lit(shortest), last - 1)).alias("n"), full.alias("f"), last.alias("l"), F.col(name_col).alias("target"))
    cut_short = cut_short.select(F.expr("left(f, length(f) - l + n)").alias("form"), "target", F.lit(2).alias("grade"))
    forms = name.unionByName(cut_short)
    if key_col:
        forms = forms.unionByName(names.where(F.col(key_col).isNotNull() & F.col(name_col).isNotNull()).select(plain(F.col(key_col)).alias("form"), F.col(name_col).alias("target"), F.lit(1).alias("grade")))
    one = forms.where(letters(F.col("form")) != "").groupBy(letters(F.col("form")).alias("letters")).agg(F.min(F.struct("grade", "form", "target")).alias("x"), F.collect_set(F.struct("grade", "target")).alias("all"))
    return one.withColumn("targets", F.array_sort(F.array_distinct(F.transform(F.filter("all", lambda a: a.grade == F.col("x.grade")), lambda a: a.target))))


def list_forms(names: DataFrame, name_col: str, key_col: str | None = None, shortest: int = 3) -> DataFrame:
    """The forms in which a list may be cited: ``form, target, exact``. Names may be misspelt; keys (abbreviations) and names
    whose last word is cut short, to at least ``shortest`` letters, must be met exactly. A form of several names is none: see
    ``ambiguous_forms``."""
    one = _forms(names, name_col, key_col, shortest).where(F.size("targets") == 1)
    return one.select("x.form", "x.target", (F.col("x.grade") > 0).alias("exact"))


def ambiguous_forms(names: DataFrame, name_col: str, key_col: str | None = None, shortest: int = 3) -> DataFrame:
    """Reported: the forms that several names share, and which therefore name none: ``form, targets``."""
    return _forms(names, name_col, key_col, shortest).where(F.size("targets") > 1).select("x.form", "targets")


def _closed(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def _triples(c: Column) -> Column:
    """The letter triples of a text without its spaces, with marks for its ends; the letters of each in alphabetical order."""
    whole = F.concat(F.lit("^^"), _closed(c), F.lit("$$"))
    return F.transform(F.sequence(F.lit(1), F.length(whole) - 2), lambda i: F.array_join(F.array_sort(F.array(*(F.substring(whole, i + k, F.lit(1)) for k in range(3)))), ""))


def _allowed(n: Column, edits: float) -> Column:
    """How many edits are allowed in a text of ``n`` letters."""
    return F.greatest(F.lit(1), F.floor(n * edits + 1e-9)).cast("int")


def _spoilt(n: Column, edits: float) -> Column:
    """How many triples of a text of ``n`` letters the allowed edits can spoil: three each, and of those that only add a letter,
    which a longer partner needs, two."""
    longest = F.floor(n / (1 - edits)).cast("int") + 1
    return F.array_max(F.transform(F.sequence(n, longest), lambda m: F.when(m - n <= _allowed(m, edits), 3 * _allowed(m, edits) - (m - n)).otherwise(0)))


def candidates(typed: DataFrame, known: DataFrame, edits: float, shared: int = 2) -> DataFrame:
    """Pairs ``kind, text_a, text_b`` of texts of one kind that may be within the allowed edits: the prefix-filtered join.

    ``typed``: ``kind, text``; ``known``: ``kind, text, exact`` (letters must be the same). Complete for changed, missing,
    added and swapped letters; letters that moved further are found too unless they spoil more triples than that.
    """
    same = F.bool_and("exact").alias("exact")
    longest = known.agg(F.max(F.length("text"))).first()[0] or 0  # one number; what is much longer has no partner
    length = F.length(_closed(F.col("text")))
    short = typed.select("kind", "text").distinct().where(length - _allowed(length, edits) <= longest)
    texts = short.select(F.lit(0).alias("side"), "kind", "text", F.lit(False).alias("exact")).unionByName(known.groupBy("kind", "text").agg(same).select(F.lit(1).alias("side"), "kind", "text", "exact"))
    key = ["side", "kind", "text", "exact"]
    each = texts.select(*key, F.posexplode(_triples(F.col("text"))).alias("at", "triple")).groupBy(*key, "triple").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    often = each.groupBy("triple").agg(F.count("*").alias("n"))
    sets = cut(each.join(often, "triple").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("n", "triple", "first", "last"))).alias("set")))

    sets = sets.withColumn("length", F.length(_closed(F.col("text")))).withColumn("size", F.size("set")).withColumn("allowed", F.when(F.col("exact"), 0).otherwise(_allowed(F.col("length"), edits)))
    sets = sets.withColumn("need", F.when(F.col("exact"), F.col("size")).otherwise(F.greatest(F.lit(1), F.col("size") - _spoilt(F.col("length"), edits))))
    upto = F.col("size") - F.col("need") + F.least(F.lit(shared), "need")
    prefix = sets.select(*key, "length", "size", "need", "allowed", F.posexplode(F.slice("set", F.lit(1), upto)).alias("place", "x")).select("*", "x.triple", "x.first", "x.last").drop("x")
    side = lambda s, x: prefix.where(F.col("side") == s).select("kind", "triple", *(F.col(c).alias(f"{c}_{x}") for c in prefix.columns if c not in ("kind", "triple", "side")))
    c = F.col
    slack = F.when(c("exact_b"), 0).otherwise(F.greatest("allowed_a", "allowed_b"))
    need = F.greatest("need_a", "need_b")
    near = (
        (F.abs(c("length_a") - c("length_b")) <= slack)
        & (c("first_a") <= c("last_b") + slack) & (c("first_b") <= c("last_a") + slack)
        & (1 + F.least("place_a", "place_b") + F.least(c("size_a") - c("place_a"), c("size_b") - c("place_b")) - 1 >= need)
    )
    met = side(0, "a").join(side(1, "b"), ["kind", "triple"]).where(near)
    return met.groupBy("kind", "text_a", "text_b").agg(F.count("*").alias("n"), F.max(need).alias("need")).where(c("n") >= F.least(F.lit(shared), "need")).select("kind", "text_a", "text_b")


def judged(pairs: DataFrame, edits: float, word_edits: float) -> DataFrame:
    """Pairs with ``distance`` (edits as a share of the longer text), ``equal`` (the same letters, as spelt), ``alike`` (within the
    allowed edits, those of each word too; within half of ``edits`` where the number of words differs) and ``jaccard``."""
    a, b = F.col("text_a"), F.col("text_b")
    changed, longer = edits_between(_closed(a), _closed(b)), F.greatest(F.length(_closed(a)), F.length(_closed(b)))
    out = pairs.withColumn("__edits", changed).withColumn("__longer", longer)
    wa, wb = F.split(a, " "), F.split(b, " ")
    each = F.forall(F.arrays_zip(wa.alias("x"), wb.alias("y")), lambda w: edits_between(w.x, w.y) <= F.greatest(F.lit(2.0), F.greatest(F.length(w.x), F.length(w.y)) * word_edits))
    alike = F.when(F.size(wa) == F.size(wb), (F.col("__edits") <= _allowed(F.col("__longer"), edits)) & each).otherwise(F.col("__edits") <= F.col("__longer") * (edits / 2))
    out = out.withColumn("distance", F.col("__edits") / F.col("__longer")).withColumn("equal", (F.col("kind") == "spelt") & (_closed(a) == _closed(b))).withColumn("alike", alike).where("equal or alike")
    one, two = F.array_distinct(_triples(a)), F.array_distinct(_triples(b))
    common = F.size(F.array_intersect(one, two))
    return out.withColumn("jaccard", common / (F.size(one) + F.size(two) - common)).drop("__edits", "__longer")


def map_to_list(values: DataFrame, value_col: str, forms: DataFrame, edits: float = 0.3, word_edits: float = 0.5) -> DataFrame:
    """Of each distinct text in ``value_col`` the closest form: ``value, target, form, jaccard, distance``.

    ``forms``: ``form, target, exact``. A form is met if its letters are those of the value or, where it need not be met
    exactly, if at most ``edits`` of the letters of the longer text (one at least) are edited and at most ``word_edits`` of each
    word (two letters at least); half of ``edits`` where the number of words differs. Texts are compared as spelt and by
    sound, each with its own kind. The form with equal letters wins, then the smallest distance, the greatest Jaccard
    similarity, the least target.

    Values without a form are not returned (the caller's anti-join reports them). Null values and values without letters or
    digits match nothing; an empty list gives an empty result; values of any length are taken whole.
    """
    shown = lambda c: F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), f(c).alias("text")) for k, f in (("spelt", words), ("said", sound))))).alias("x")
    typed = values.select(F.col(value_col).alias("value")).where("value is not null").distinct().select("value", shown(plain(F.col("value")))).select("value", "x.*").where("text <> ''")
    known = forms.select("form", "target", "exact", shown(F.col("form"))).select("form", "target", "exact", "x.*").where("text <> '' and (kind = 'spelt' or not exact)")
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = candidates(typed, known, edits).repartition(parts, "text_a", "text_b")  # few bytes but much to compute: spread by number
    near = judged(pairs, edits, word_edits)
    rows = near.join(typed.withColumnRenamed("text", "text_a"), ["kind", "text_a"]).join(known.withColumnRenamed("text", "text_b"), ["kind", "text_b"])
    rows = rows.where(F.col("equal") | (~F.col("exact") & F.col("alike")))
    best = rows.groupBy("value").agg(F.min(F.struct((~F.col("equal")).alias("e"), "distance", (-F.col("jaccard")).alias("j"), "target", "form")).alias("x"))
    return best.select("value", "x.target", "x.form", (-F.col("x.j")).alias("jaccard"), "x.distance")
