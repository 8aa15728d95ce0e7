"""Queries p1 to p3: orphan references, filled codes, flattened sense trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.links import attribute, open_tags
from ..functions.normalize import FINALS, FORMS_OF, LETTERS_OF, ORDINARY, SEVERAL, WS, entry_id, hebrew_letters, read_code, sage_id
from ..operators.fill import Field, fill_from_groups, filled_values
from ..operators.index import page_of
from ..operators.nested import flatten_senses, sense_texts
from ..operators.orphans import by_table_and_month, intervals, orphans
from ..session import cut, table

#: The codes of parts of speech and genders, and the parts of speech that have a gender.
PARTS, GENDERS, GENDERED = ("n", "v", "a", "av", "pt", "ij", "cj"), ("m", "f"), ("n", "a", "pt")


# p1


def p1_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orphan references with reason, date of the reference and first delivery of the target. The intervals, with what the
    newest row of each key refers to, are made once and written to the checkpoint folder: they are both sides of the merge."""
    entries, sages, removals = (table(spark, sf_dir, t) for t in ("entries", "sages", "removals"))
    gone = lambda t: removals.where(F.col("tbl") == t)

    hrefs = F.transform(F.flatten(F.transform("texts", open_tags)), lambda t: attribute(t, "href"))
    targets = F.array_distinct(F.transform(F.filter(hrefs, lambda h: h.contains("#rid:") | h.contains("#sage:")), _target))
    linked = sense_texts(entries.select("id", "seq", "loaded_at", "c"), "c", "id", "seq", "loaded_at", containing="href", every=True)
    linked = linked.select("id", "seq", "loaded_at", targets.alias("targets"), F.to_date("loaded_at").alias("ref_date"))
    entry_spans = intervals(linked, gone("entries"), entry_id(F.col("id")), entry_id(F.col("rid")), "seq", "targets", "ref_date")

    related = F.transform(F.array_distinct(F.transform("relationships", lambda r: sage_id(r.target))), lambda x: F.struct(F.lit("sages").alias("target_table"), x.alias("target_key")))
    people = sages.select("id", "pos", "loaded_at", related.alias("targets"), F.to_date("loaded_at").alias("ref_date"))
    sage_spans = intervals(people, gone("sages"), sage_id(F.col("id")), sage_id(F.col("rid")), "pos", "targets", "ref_date")

    parents = cut(entry_spans.withColumn("table", F.lit("entries")).unionByName(sage_spans.withColumn("table", F.lit("sages"))))
    own = parents.where("valid_to is null").select(F.col("table").alias("src_table"), F.col("key").alias("src_key"), F.explode("targets").alias("t"), "ref_date")
    notes = table(spark, sf_dir, "annotations").select(F.lit("annotations").alias("src_table"), F.col("ann_id").cast("string").alias("src_key"), F.lit("entries").alias("target_table"), entry_id(F.col("rid")).alias("target_key"), F.col("created").alias("ref_date"))
    refs = own.select("src_table", "src_key", "t.target_table", "t.target_key", "ref_date").unionByName(notes)
    return orphans(refs, parents.select("table", "key", "valid_from", "valid_to"))


def _target(href: Column) -> Column:
    """The table and key that a link address refers to; the key is null where nothing stands after the mark."""
    found = F.regexp_extract(F.replace(href, F.lit("&nbsp;"), F.lit(" ")), "(?s)#(rid|sage):(.*)$", 2)
    rid = href.contains("#rid:")
    return F.struct(F.when(rid, "entries").otherwise("sages").alias("target_table"), F.when(rid, entry_id(found)).otherwise(sage_id(found)).alias("target_key"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_orphans(spark, sf_dir).select("src_table", "src_key", "target_key")


def p1_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every orphan with its reason and the date of the reference."""
    return p1_orphans(spark, sf_dir).select("src_table", "src_key", "target_table", "target_key", "ref_date", "reason")


def p1_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_table_and_month(p1_orphans(spark, sf_dir))


# p2


def _codes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Column], list[Field]]:
    fields = [
        Field("ps", read_code(F.col("ps"), *PARTS)),
        Field("gn", read_code(F.col("gn"), *GENDERS), when=lambda done: done["ps"].isin(*GENDERED)),
    ]
    return table(spark, sf_dir, "entries").select("seq", "hw", "g.ps", "g.gn"), [hebrew_letters(F.col("hw"))], fields


def p2_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry with its codes, read or filled from the entries of the same letters, and the level they came from."""
    return fill_from_groups(*_codes(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values filled."""
    entries, levels, fields = _codes(spark, sf_dir)
    return filled_values(entries, "seq", levels, fields).drop("level")


#: Values that a group must hold to fill from, in the query of the hierarchy.
SUPPORT = 3


def p2_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hierarchy: part of speech (mode) and printed page (median) from the entries of the same letters, else of the same
    first two letters, else of the same part of the file, each group with at least three values."""
    entries = table(spark, sf_dir, "entries").select("seq", "hw", "part", "g.ps", "p")
    letters = hebrew_letters(F.col("hw"))
    fields = [Field("ps", read_code(F.col("ps"), *PARTS)), Field("page", page_of(F.col("p")), numeric=True)]
    return filled_values(entries, "seq", [letters, F.substring(letters, 1, 2), F.col("part")], fields, SUPPORT)


def p2_unfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported: the codes that stay empty (a gender only where the part of speech has one or is unknown)."""
    gap = F.array(F.when(F.col("ps_value").isNull(), F.lit("ps")), F.when(F.col("gn_value").isNull() & F.coalesce(F.col("ps_value").isin(*GENDERED), F.lit(True)), F.lit("gn")))
    return p2_filled(spark, sf_dir).select("seq", F.explode(F.array_compact(gap)).alias("field"))


_DUCK_WS = WS.replace("\\x{0085}", "\\x{85}")


def _letters_sql(column: str) -> str:
    c = f"translate(coalesce({column}, ''), '{FORMS_OF}', '{LETTERS_OF}')"
    for mark, letters in SEVERAL:
        c = f"replace({c}, '{mark}', '{letters}')"
    return f"translate(regexp_replace({c}, '[^א-ת]', '', 'g'), '{FINALS}', '{ORDINARY}')"


def _code_sql(column: str, known: tuple[str, ...]) -> str:
    code = f"regexp_replace(lower(regexp_replace({column}, '^[{_DUCK_WS}]+|[{_DUCK_WS}]+$', '', 'g')), '[{_DUCK_WS}]*\\.$', '')"
    return f"case when {code} in ({', '.join(map(repr, known))}) then {code} end"


_P2 = f"""
WITH e AS (SELECT seq, {_letters_sql("hw")} AS k, {_code_sql("g.ps", PARTS)} AS ps, {_code_sql("g.gn", GENDERS)} AS gn FROM entries),
p AS (SELECT k, v AS ps_mode FROM (SELECT k, ps AS v, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, ps) AS r FROM e WHERE k <> '' AND ps IS NOT NULL GROUP BY k, ps) WHERE r = 1),
q AS (SELECT k, v AS gn_mode FROM (SELECT k, gn AS v, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, gn) AS r FROM e WHERE k <> '' AND gn IS NOT NULL GROUP BY k, gn) WHERE r = 1),
f AS (SELECT seq, ps, gn, coalesce(ps, ps_mode) AS ps_value, CASE WHEN gn IS NOT NULL THEN gn WHEN coalesce(ps, ps_mode) IN ('n', 'a', 'pt') THEN gn_mode END AS gn_value FROM e LEFT JOIN p USING (k) LEFT JOIN q USING (k))
"""


_PAGE = r"nullif(try_cast(regexp_extract(coalesce(p, ''), '^\s*([0-9]+)\s*$', 1) AS INTEGER), 0)"


def _level_sql(j: int) -> str:
    at = lambda f: f"SELECT k{j} AS k, {f} AS v, sum(count(*)) OVER (PARTITION BY k{j}) AS n, sum(count(*)) OVER (PARTITION BY k{j} ORDER BY {f}) AS upto, row_number() OVER (PARTITION BY k{j} ORDER BY count(*) DESC, {f}) AS r FROM e WHERE k{j} <> '' AND {f} IS NOT NULL GROUP BY k{j}, {f}"
    return f"a{j} AS (SELECT k, v AS ps_v, n AS ps_n FROM ({at('ps')}) WHERE r = 1), b{j} AS (SELECT k, min(v) AS pg_v, any_value(n) AS pg_n FROM ({at('page')}) WHERE upto * 2 >= n GROUP BY k)"


_BACKOFF = f"""
WITH l AS (SELECT seq, part, {_letters_sql("hw")} AS k, {_code_sql("g.ps", PARTS)} AS ps, {_PAGE} AS page FROM entries),
e AS (SELECT seq, k AS k0, left(k, 2) AS k1, CAST(part AS VARCHAR) AS k2, ps, page FROM l),
{", ".join(map(_level_sql, range(3)))},
j AS (SELECT e.seq, e.ps, e.page, {", ".join(f"CASE WHEN a{i}.ps_n >= {SUPPORT} THEN a{i}.ps_v END AS p{i}, CASE WHEN b{i}.pg_n >= {SUPPORT} THEN b{i}.pg_v END AS g{i}" for i in range(3))} FROM e {" ".join(f"LEFT JOIN a{i} ON a{i}.k = e.k{i} LEFT JOIN b{i} ON b{i}.k = e.k{i}" for i in range(3))})
SELECT seq, 'ps' AS field, coalesce(p0, p1, p2) AS value, CASE WHEN p0 IS NOT NULL THEN 0 WHEN p1 IS NOT NULL THEN 1 ELSE 2 END AS level FROM j WHERE ps IS NULL AND coalesce(p0, p1, p2) IS NOT NULL
UNION ALL SELECT seq, 'page', CAST(coalesce(g0, g1, g2) AS VARCHAR), CASE WHEN g0 IS NOT NULL THEN 0 WHEN g1 IS NOT NULL THEN 1 ELSE 2 END FROM j WHERE page IS NULL AND coalesce(g0, g1, g2) IS NOT NULL
"""


# p3


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_senses(table(spark, sf_dir, "entries"), "c", "seq").where("kind <> 'unreadable'").select("seq", "kind", "path", "parent")


def p3_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senses and forms with their texts."""
    return flatten_senses(table(spark, sf_dir, "entries"), "c", "seq", text=True).where("kind <> 'unreadable'")


def p3_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported: the entries without a readable tree, and why."""
    return flatten_senses(table(spark, sf_dir, "entries"), "c", "seq").where("kind = 'unreadable'").select("seq", F.col("path").alias("reason"))


QUERIES = {f.__name__: f for f in (p1_found, p1_reasons, p1_by_month, p2_found, p2_filled, p2_unfilled, p2_backoff, p3_found, p3_tables, p3_unreadable)}

_TRIM = lambda c: f"nullif(regexp_replace({c}, '^[{_DUCK_WS}]+|[{_DUCK_WS}]+$', '', 'g'), '')"
_ENTRY, _SAGE = (lambda c: f"upper({_TRIM(c)})"), (lambda c: f"lower({_TRIM(c)})")


def _spans_sql(name: str, kind: str, key, order: str) -> str:
    seen = f"SELECT {key('id')} AS k, min(loaded_at) AS f, max(loaded_at) AS l, max({order}) AS top FROM {kind} WHERE id IS NOT NULL GROUP BY 1"
    gone = f"SELECT {key('rid')} AS k, max(removed_at) AS r FROM removals WHERE tbl = '{kind}' GROUP BY 1"
    return f"{name} AS (SELECT s.k, f, top, coalesce(r > l, false) AS gone FROM ({seen}) s LEFT JOIN ({gone}) g USING (k) WHERE s.k IS NOT NULL)"


# In JSON text quotes are escaped once, or three times where the tree is a string in a string.
_TEXT = "replace(replace(replace(replace(c, '\\\\\\\"', '\"'), '\\\"', '\"'), '\\u00a0', chr(160)), '\\t', chr(9))"
_P1 = f"""
WITH {_spans_sql('es', 'entries', _ENTRY, 'seq')}, {_spans_sql('ss', 'sages', _SAGE, 'pos')},
h AS (SELECT es.k, CAST(loaded_at AS DATE) AS d, unnest(regexp_extract_all({_TEXT}, '(?is)<a\\s[^>]*?href\\s*=\\s*("[^"]*"|''[^'']*'')', 1)) AS q FROM entries JOIN es ON es.k = {_ENTRY('id')} AND seq = top AND NOT gone WHERE json_valid(c)),
t AS (SELECT k, d, replace(substr(q, 2, length(q) - 2), '&nbsp;', ' ') AS q FROM h),
r AS (SELECT DISTINCT 'entries' AS src_table, k AS src_key, CASE WHEN contains(q, '#rid:') THEN 'e' ELSE 's' END AS kind, CASE WHEN contains(q, '#rid:') THEN {_ENTRY("regexp_extract(q, '(?s)#rid:(.*)$', 1)")} ELSE {_SAGE("regexp_extract(q, '(?s)#sage:(.*)$', 1)")} END AS target_key, d FROM t WHERE contains(q, '#rid:') OR contains(q, '#sage:')
UNION ALL SELECT 'annotations', CAST(ann_id AS VARCHAR), 'e', {_ENTRY('rid')}, created FROM annotations
UNION ALL SELECT DISTINCT 'sages', k, 's', {_SAGE('x')}, d FROM (SELECT ss.k, unnest(relationships).target AS x, CAST(loaded_at AS DATE) AS d FROM sages JOIN ss ON ss.k = {_SAGE('id')} AND pos = top AND NOT gone)),
p AS (SELECT 'e' AS kind, * FROM es UNION ALL SELECT 's', * FROM ss),
o AS (SELECT r.*, CASE WHEN p.k IS NULL THEN 'missing' WHEN p.gone THEN 'deleted' WHEN CAST(p.f AS DATE) > r.d THEN 'late' END AS reason FROM r LEFT JOIN p ON p.kind = r.kind AND p.k = r.target_key WHERE r.target_key IS NOT NULL)
"""

_BOX = "CASE json_type({0}) WHEN 'ARRAY' THEN CAST({0} AS JSON[]) WHEN 'OBJECT' THEN [{0}] ELSE [] END"
SENSE_TREE = f"""
WITH RECURSIVE d AS (SELECT seq, CASE WHEN json_type(c) = 'VARCHAR' THEN TRY_CAST(json_extract_string(c, '$') AS JSON) ELSE CAST(c AS JSON) END AS j FROM entries WHERE json_valid(c)),
b AS (SELECT seq, {_BOX.format('s')} AS l FROM (SELECT seq, CASE json_type(j) WHEN 'ARRAY' THEN j WHEN 'OBJECT' THEN coalesce(json_extract(j, '$.s'), json_extract(j, '$.senses')) END AS s FROM d)),
n AS (
    SELECT seq, CAST(i AS VARCHAR) AS path, '' AS parent, e FROM (SELECT seq, unnest(l) AS e, generate_subscripts(l, 1) - 1 AS i FROM b) WHERE json_type(e) = 'OBJECT'
    UNION ALL
    SELECT seq, parent || '.' || i, parent, e FROM (SELECT seq, path AS parent, unnest(l) AS e, generate_subscripts(l, 1) - 1 AS i FROM (SELECT seq, path, {_BOX.format('s')} AS l FROM (SELECT seq, path, coalesce(json_extract(e, '$.s'), json_extract(e, '$.senses')) AS s FROM n))) WHERE json_type(e) = 'OBJECT'
),
g AS (SELECT seq, path, CASE json_type(f) WHEN 'ARRAY' THEN CAST(f AS JSON[]) WHEN 'VARCHAR' THEN [f] ELSE [] END AS l FROM (SELECT seq, path, coalesce(json_extract(e, '$.g.bf'), json_extract(e, '$.grammar.binyan_form')) AS f FROM n)),
x AS (SELECT seq, path, i, x FROM (SELECT seq, path, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS i FROM g) WHERE json_type(x) = 'VARCHAR')
"""


def string_sql(*paths: str) -> str:
    return f"coalesce({', '.join(f"""CASE WHEN json_type(e, '{p}') = 'VARCHAR' THEN json_extract_string(e, '{p}') END""" for p in paths)})"


_P3_FOUND = SENSE_TREE + "SELECT seq, 'sense' AS kind, path, parent FROM n UNION ALL SELECT seq, 'form', path || ':' || i, path FROM x"
_P3_TABLES = SENSE_TREE + f"SELECT seq, 'sense' AS kind, path, parent, CAST(split_part(path, '.', -1) AS BIGINT) AS pos, {string_sql('$.d', '$.definition')} AS d, {string_sql('$.n', '$.number')} AS n, {string_sql('$.g.vs', '$.grammar.verbal_stem')} AS vs, NULL AS form FROM n UNION ALL SELECT seq, 'form', path || ':' || i, path, i, NULL, NULL, NULL, json_extract_string(x, '$') FROM x"

ORACLE = {
    "p1_found": _P1 + "SELECT src_table, src_key, target_key FROM o WHERE reason IS NOT NULL",
    "p1_reasons": _P1 + "SELECT src_table, src_key, CASE kind WHEN 'e' THEN 'entries' ELSE 'sages' END AS target_table, target_key, d AS ref_date, reason FROM o WHERE reason IS NOT NULL",
    "p1_by_month": _P1 + "SELECT src_table, CAST(date_trunc('month', d) AS DATE) AS month, reason, count(*) AS n FROM o WHERE reason IS NOT NULL GROUP BY ALL",
    "p2_filled": _P2 + "SELECT seq, e.hw, e.g.ps AS ps, e.g.gn AS gn, ps_value, CASE WHEN f.ps IS NULL AND ps_value IS NOT NULL THEN 0 END AS ps_level, gn_value, CASE WHEN f.gn IS NULL AND gn_value IS NOT NULL THEN 0 END AS gn_level FROM f JOIN entries e USING (seq)",
    "p2_backoff": _BACKOFF,
    "p3_found": _P3_FOUND,
    "p3_tables": _P3_TABLES,
    "p2_found": _P2 + "SELECT seq, 'ps' AS field, ps_value AS value FROM f WHERE ps IS NULL AND ps_value IS NOT NULL UNION ALL SELECT seq, 'gn', gn_value FROM f WHERE gn IS NULL AND gn_value IS NOT NULL",
    "p2_unfilled": _P2 + "SELECT seq, 'ps' AS field FROM f WHERE ps_value IS NULL UNION ALL SELECT seq, 'gn' FROM f WHERE gn_value IS NULL AND (ps_value IS NULL OR ps_value IN ('n', 'a', 'pt'))",
    "p3_unreadable": "SELECT seq, CASE WHEN c IS NULL THEN 'null' WHEN trim(c) = '' THEN 'empty' ELSE 'broken' END AS reason FROM entries WHERE c IS NULL OR NOT json_valid(c)",
}
