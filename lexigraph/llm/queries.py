"""Queries p4 to p8 and their SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.links import anchors, attribute
from ..operators.nested import sense_texts
from ..session import cut, table
from .canonical import ambiguous_forms, list_forms, map_to_list, plain
from .encode import encode
from .looks import ALIKE, IGNORABLE, look_alikes, look_form
from .mix import mix, shares, short_sources
from .split import split_texts

#: Fixed values of this project's data.
LIMIT, OVERLAP = 512, 64
#: A curriculum: glossaries early, responsa and lectures late, the other sources evenly.
SCHEDULE = {"glossary": [(0.0, 1.5), (1.0, 0.5)], "responsum": [(0.0, 0.5), (1.0, 1.5)], "lecture": [(0.0, 0.5), (0.5, 1.0), (1.0, 1.5)]}


#: The groups of works that are cited; words before a citation; the place within a work at its end.
WORKS = ("talmudic_tractates", "biblical_books", "midrashic_rabbinic")
BEFORE = r"^[(\s]*(?:(?:cmp|comp|cf|bab|talm|mishn|tract|see|in|y|v)(?:\.\s*|\s+))*"
PLACE = r"(?:[\s,;.]+(?:(?:fol|col|ch|p)\.?\s*)?(?:\d+\s*:\s*\d+|\d+\s*[ab]?|[ivxlc]+\s*,\s*\d+)(?:\s*bot\.?)?)+[\s.)]*$"


# p4


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All citations: ``ref_no``, ``cited`` (the text as typed) and ``work`` (what names the work in it)."""
    held = sense_texts(table(spark, sf_dir, "entries"), "c", "seq", containing="ref-link")
    link = held.select(F.explode(F.flatten(F.transform("texts", anchors))).alias("link")).where(F.contains("link", F.lit("ref-link")))
    link = link.where(F.regexp_like(attribute(F.col("link"), "class"), F.lit(r"(^|\s)ref-link(\s|$)")))
    cited = link.select(F.try_to_number(F.regexp_extract(attribute(F.col("link"), "href"), r"(\d+)\s*$", 1), F.lit("9" * 18)).cast("bigint").alias("ref_no"), F.regexp_replace("link", "<[^>]*>", "").alias("cited"))
    work = F.regexp_replace(F.regexp_replace(plain(F.col("cited")), BEFORE, ""), PLACE, "")
    return cited.where("ref_no is not null").withColumn("work", F.regexp_replace(work, r"^[(\s]+|[.)\s]+$", ""))


def _works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lookup").where(F.col("grp").isin(*WORKS))


def _mapped(cited: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_to_list(cited, "work", list_forms(_works(spark, sf_dir), "value", "key"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = cut(citations(spark, sf_dir).select("ref_no", "work").distinct())
    return cited.join(_mapped(cited, spark, sf_dir).select(F.col("value").alias("work"), F.col("target").alias("value")), "work").select("ref_no", "value").distinct()


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported: the citations of works not listed, by what they name."""
    cited = cut(citations(spark, sf_dir).select("ref_no", "work").distinct())
    mapped = _mapped(cited, spark, sf_dir).select(F.col("value").alias("work"))
    return cited.join(mapped, "work", "left_anti").groupBy("work").agg(F.count("*").alias("citations"))


def p4_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported: the forms that several works share, and that name none of them."""
    return ambiguous_forms(_works(spark, sf_dir), "value", "key")


# p5


def p5_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry with the one form of its headword."""
    return table(spark, sf_dir, "entries").select("seq", look_form(F.col("hw")).alias("form"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alikes(table(spark, sf_dir, "entries"), "hw", "seq")


def _forms_sql(column: str) -> str:
    """The form in SQL, for the characters that occur in Hebrew, Latin, Greek and Cyrillic text."""
    single = {a: b for a, b in ALIKE.items() if len(b) == 1}
    several = {a: b for a, b in ALIKE.items() if len(b) > 1}
    for code in [*range(0x2135, 0x2139), *range(0x2160, 0x2180), *range(0xFB00, 0xFB50), *range(0xFF01, 0xFF5F)]:
        new = unicodedata.normalize("NFKD", c := chr(code))
        new = "".join(ALIKE.get(x, x) for x in new)
        if new != c and c not in ALIKE:
            (single if len(new) == 1 else several)[c] = new
    blanks = "".join(chr(c) for c in [9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
    single |= {c: " " for c in blanks}
    ignored = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in IGNORABLE)
    q = lambda s: s.replace("'", "''")
    c = f"regexp_replace({column}, '[{ignored}]', '', 'g')"
    for a, b in several.items():
        c = f"replace({c}, '{q(a)}', '{q(b)}')"
    return f"trim(nfc_normalize(translate({c}, '{q(''.join(single))}', '{q(''.join(single.values()))}')), ' ')"


# p6


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), "text", "doc_id")


# p7


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources whose texts end before the run does, when each document counts for itself."""
    targets = table(spark, sf_dir, "mix_targets")
    return short_sources(mix(table(spark, sf_dir, "documents"), targets, SCHEDULE, every=True), targets).select("source")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus in training order."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), SCHEDULE).drop("wanted", "given")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported: the shares really reached."""
    targets = table(spark, sf_dir, "mix_targets")
    return shares(mix(table(spark, sf_dir, "documents"), targets, SCHEDULE), targets)


# p8


def p8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_texts(table(spark, sf_dir, "documents"), "text", "doc_id", limit=LIMIT, overlap=OVERLAP)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that came out as more than one piece."""
    return p8_pieces(spark, sf_dir).where("piece_no = 1").select("doc_id")


QUERIES = {f.__name__: f for f in (p4_found, p4_unmatched, p4_ambiguous, p5_found, p5_forms, p6_ids, p7_found, p7_mix, p7_shares, p8_found, p8_pieces)}

_FORMS = f"WITH f AS (SELECT seq, hw, {_forms_sql('hw')} AS form FROM entries)"

ORACLE = {
    "p5_forms": f"{_FORMS} SELECT seq, form FROM f",
    "p5_found": f"{_FORMS} SELECT a.seq AS seq_a, b.seq AS seq_b FROM f a JOIN f b ON a.form = b.form AND a.seq < b.seq AND a.hw <> b.hw WHERE a.form <> ''",
}
