"""The queries of the lexicon and the graph, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display, routes, validate
from ..functions.normalize import FINALS, JS_WS, ORDINARY, WS, entry_id, normalize_hebrew, normalize_reference
from ..operators import annotate, crud, etl, graph, history, index, layout, paging, search, senses
from ..operators.nested import flatten_senses, sense_texts
from ..session import bounded, table
from ..sources.jsonl import split_at
from .quality import SENSE_TREE, string_sql

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return index.with_keys(table(spark, d, "entries"))


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return index.entry_refs(table(spark, d, "entries"))


def _sages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sages")


_D_TEXT = f"{SENSE_TREE}, t AS (SELECT seq, path, {string_sql('$.d', '$.definition')} AS d FROM n)"


def _definitions(spark: SparkSession, d: str) -> DataFrame:
    """The definitions at all depths: ``seq, path, d``."""
    return flatten_senses(table(spark, d, "entries"), "c", "seq", text=True).where("kind = 'sense'").select("seq", "path", "d")


def _values(spark: SparkSession, values: list, schema: str) -> DataFrame:
    return spark.createDataFrame(values, schema)


def _sql_values(rows: list[tuple]) -> str:
    lit = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


def _heb(c: str) -> str:
    return f"translate(regexp_replace(coalesce({c}, ''), '[^א-ת]', '', 'g'), '{FINALS}', '{ORDINARY}')"


def _ref(c: str) -> str:
    return f"trim(regexp_replace(replace(lower({c}), '.', ''), '[{JS_WS}]+', ' ', 'g'))"


_PAGE = r"nullif(try_cast(regexp_extract(coalesce(p, ''), '^\s*([0-9]+)\s*$', 1) AS INTEGER), 0)"
_E = f"e AS (SELECT *, {_heb('hw')} AS norm, {_PAGE} AS page FROM entries)"
_R = f"r0 AS (SELECT seq, unnest(map_entries(rf)) AS m FROM entries), r1 AS (SELECT seq, m.key AS category, m.value AS refs FROM r0), r2 AS (SELECT seq, category, unnest(refs) AS ref, generate_subscripts(refs, 1) - 1 AS pos FROM r1), r AS (SELECT *, {_ref('ref')} AS norm FROM r2 WHERE ref IS NOT NULL)"
_FIRST = "f AS (SELECT norm, arg_min(hw, seq) AS hw, min(seq) AS seq FROM e GROUP BY norm)"
_SORTED = "s AS (SELECT ref, norm, min(struct_pack(a := seq, b := category, c := pos)) AS x FROM r GROUP BY ref, norm), t AS (SELECT ref, norm, x.a AS first_seq, x.c AS first_pos FROM s)"

# Point lookups, pages, ranges


@query(f"WITH {_E}, k AS (SELECT DISTINCT upper(regexp_replace(rid, '^[{WS}]+|[{WS}]+$', '', 'g')) AS id FROM annotations WHERE rid IS NOT NULL), l AS (SELECT e.id, max(seq) AS seq FROM e JOIN k ON e.id = k.id WHERE k.id <> '' GROUP BY e.id) SELECT e.id, e.seq, e.hw FROM e JOIN l USING (seq)")
def rid_last_wins(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "annotations").select(entry_id(F.col("rid")).alias("id")).where("id is not null")
    return search.by_id(_entries(spark, d).select("id", "seq", "hw"), ids)


@query("WITH k AS (SELECT DISTINCT rid AS id FROM annotations) SELECT k.id, coalesce(max(e.seq), -1) AS ordinal FROM k LEFT JOIN entries e ON e.id = k.id GROUP BY k.id")
def ordinals(spark: SparkSession, d: str) -> DataFrame:
    return search.ordinal(table(spark, d, "entries"), table(spark, d, "annotations").select(F.col("rid").alias("id")))


@query(f"WITH {_E} SELECT seq, id, page FROM e WHERE page = 7")
def by_page(spark: SparkSession, d: str) -> DataFrame:
    return paging.on_page(_entries(spark, d), 7).select("seq", "id", "page")


@query(f"WITH {_E} SELECT coalesce(min(seq), -1) AS start FROM e WHERE page = 7")
def page_start(spark: SparkSession, d: str) -> DataFrame:
    return paging.page_start(_entries(spark, d), 7)


@query("SELECT seq, id FROM entries WHERE seq BETWEEN 120 AND 169")
def range_page(spark: SparkSession, d: str) -> DataFrame:
    return paging.rows_range(table(spark, d, "entries"), 120, 50).select("seq", "id")


@query(f"WITH {_E}, s AS (SELECT min(seq) AS a FROM e WHERE page = 9) SELECT seq, id FROM e, s WHERE seq >= a AND seq < a + 50")
def initial_window(spark: SparkSession, d: str) -> DataFrame:
    return paging.initial_window(_entries(spark, d), 9).select("seq", "id")


@query(f"WITH {_E} SELECT page, count(*) AS n, min(seq) AS first, max(seq) AS last FROM e WHERE page IS NOT NULL GROUP BY page")
def page_index(spark: SparkSession, d: str) -> DataFrame:
    return index.key_index(_entries(spark, d), "page")


@query("SELECT seq, lag(hw) OVER (ORDER BY seq) AS prev, lead(hw) OVER (ORDER BY seq) AS next FROM entries")
def stored_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return index.neighbours(table(spark, d, "entries"))


@query("SELECT count(*) AS total, greatest(count(*) - 50, 0) AS remaining FROM entries WHERE g.ps = 'v'")
def result_cap(spark: SparkSession, d: str) -> DataFrame:
    return search.capped(table(spark, d, "entries").where("g.ps = 'v'"), "seq")[1]


@query("SELECT seq, part, id, hw, CASE WHEN seq < 100 THEN 1 ELSE 2 END AS new_part FROM entries")
def full_export(spark: SparkSession, d: str) -> DataFrame:
    split = split_at(table(spark, d, "entries").withColumnRenamed("part", "old"), 100)
    return split.select("seq", F.col("old").alias("part"), "id", "hw", F.col("part").alias("new_part"))


# Headwords


@query(f"WITH {_E}, {_FIRST} SELECT norm, hw, seq FROM f WHERE starts_with(norm, 'א') ORDER BY norm LIMIT 8")
def prefix_headwords(spark: SparkSession, d: str) -> DataFrame:
    return search.prefix_headwords(_entries(spark, d), "אָ").select("norm", "hw", "seq")


_WORDS = [("א",), ("אב",), ("שׁמ",), ("תתת",), ("abc",), ("ךך",), ("",), (None,)]


@query(f"WITH {_E}, {_FIRST}, q AS (SELECT query, {_heb('query')} AS k FROM (VALUES {_sql_values(_WORDS)}) v(query)), m AS (SELECT query, norm, hw, row_number() OVER (PARTITION BY query ORDER BY norm) AS rank FROM q JOIN f ON starts_with(norm, k) WHERE k <> '') SELECT query, CAST(rank AS INTEGER) AS rank, norm, hw FROM m WHERE rank <= 8")
def prefix_headwords_batch(spark: SparkSession, d: str) -> DataFrame:
    return search.prefix_headwords_batch(_entries(spark, d), _values(spark, _WORDS, "query string"))


@query(f"WITH {_E}, k AS (SELECT coalesce(min(CASE WHEN norm >= 'שלומות' THEN norm END), max(norm)) AS norm FROM e) SELECT e.seq, e.norm, e.hw FROM e JOIN k USING (norm)")
def nearest_headword(spark: SparkSession, d: str) -> DataFrame:
    return search.nearest(_entries(spark, d), "שָׁלוֹמוֹת").select("seq", "norm", "hw")


@query(f"WITH {_E}, q AS (SELECT DISTINCT key AS query, '' AS k FROM lookup UNION ALL SELECT DISTINCT name.he, {_heb('name.he')} FROM sages) SELECT query, coalesce((SELECT min(norm) FROM e WHERE norm >= k), (SELECT max(norm) FROM e)) AS key FROM q")
def nearest_headword_batch(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "lookup").select(F.col("key").alias("query")).unionByName(_sages(spark, d).select(F.col("name.he").alias("query")))
    return search.nearest_batch(_entries(spark, d), asked)


@query(f"WITH {_E} SELECT norm, count(*) AS n, min(seq) AS first, max(seq) AS last FROM e GROUP BY norm")
def headword_index(spark: SparkSession, d: str) -> DataFrame:
    return index.key_index(_entries(spark, d), "norm")


@query(f"WITH {_E} SELECT norm, seq FROM e")
def headword_rows(spark: SparkSession, d: str) -> DataFrame:
    return index.key_rows(_entries(spark, d), "norm")


@query(f"WITH {_E} SELECT DISTINCT norm FROM e")
def sorted_headwords(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("norm").distinct().sort("norm")


@query(f"SELECT seq, {_heb('hw')} AS norm FROM entries")
def normalize_headwords(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entries").select("seq", normalize_hebrew(F.col("hw")).alias("norm"))


# References


@query(f"WITH {_R} SELECT seq, category, CAST(pos AS INTEGER) AS pos, ref, norm FROM r")
def entry_references(spark: SparkSession, d: str) -> DataFrame:
    return _refs(spark, d)


@query(f"WITH {_R} SELECT ref, count(*) AS n, min(seq) AS first, max(seq) AS last FROM r GROUP BY ref")
def reference_index(spark: SparkSession, d: str) -> DataFrame:
    return index.key_index(_refs(spark, d), "ref")


@query(f"WITH {_R}, {_SORTED} SELECT ref, norm, first_seq, CAST(first_pos AS INTEGER) AS first_pos FROM t")
def sorted_references(spark: SparkSession, d: str) -> DataFrame:
    return index.sorted_references(_refs(spark, d))


@query(f"WITH {_R}, {_SORTED} SELECT ref, norm, first_seq FROM t WHERE starts_with(norm, 'bava k') ORDER BY norm, first_seq, first_pos, ref LIMIT 8")
def prefix_references(spark: SparkSession, d: str) -> DataFrame:
    return search.prefix_references(index.sorted_references(_refs(spark, d)), "Bava  K").select("ref", "norm", "first_seq")


_CITED = [("Bava Kamrot",), ("bava k",), ("Toldaniah",), ("Toldaniah 5",), ("Toldaniah 53:3",), ("Orv.",), ("",), (None,)]


@query(f"WITH {_R}, {_SORTED}, q AS (SELECT query, {_ref('query')} AS k FROM (VALUES {_sql_values(_CITED)}) v(query)), m AS (SELECT query, norm, ref, row_number() OVER (PARTITION BY query ORDER BY norm, first_seq, first_pos, ref) AS rank FROM q JOIN t ON starts_with(norm, k) WHERE k <> '') SELECT query, CAST(rank AS INTEGER) AS rank, norm, ref FROM m WHERE rank <= 8")
def prefix_references_batch(spark: SparkSession, d: str) -> DataFrame:
    return search.prefix_references_batch(index.sorted_references(_refs(spark, d)), _values(spark, _CITED, "query string"))


@query(f"WITH {_R} SELECT DISTINCT seq FROM r WHERE starts_with(norm, 'toldaniah') AND (norm = 'toldaniah' OR substr(norm, 10, 1) IN (':', ' '))")
def by_reference(spark: SparkSession, d: str) -> DataFrame:
    return search.by_reference(table(spark, d, "entries"), _refs(spark, d), "Toldaniah.").select("seq")


@query(f"WITH {_R}, q AS (SELECT query, {_ref('query')} AS k FROM (VALUES {_sql_values(_CITED)}) v(query)) SELECT DISTINCT query, seq FROM q JOIN r ON starts_with(norm, k) WHERE k <> '' AND (norm = k OR substr(norm, length(k) + 1, 1) IN (':', ' '))")
def by_reference_batch(spark: SparkSession, d: str) -> DataFrame:
    return search.by_reference_batch(_refs(spark, d), _values(spark, _CITED, "query string"))


_CATEGORY = "CASE grp WHEN 'talmudic_tractates' THEN 't' WHEN 'biblical_books' THEN 'b' WHEN 'midrashic_rabbinic' THEN 'mi' END"


@query(f"WITH {_R}, b AS (SELECT DISTINCT lower(value) AS book, {_CATEGORY} AS category FROM lookup WHERE {_CATEGORY} IS NOT NULL), m AS (SELECT seq, ref, arg_max(category, length(book)) AS category FROM (SELECT DISTINCT seq, ref FROM r) JOIN b ON lower(ref) = book OR starts_with(lower(ref), book || ' ') GROUP BY seq, ref), a AS (SELECT d.seq, coalesce(m.category, 'o') AS category, d.ref FROM (SELECT DISTINCT seq, ref FROM r) d LEFT JOIN m ON m.seq = d.seq AND m.ref = d.ref) SELECT seq, category, list(ref ORDER BY ref) AS refs FROM a GROUP BY seq, category")
def reference_categories(spark: SparkSession, d: str) -> DataFrame:
    books = table(spark, d, "lookup").select(F.col("value").alias("book"), F.when(F.col("grp") == "talmudic_tractates", "t").when(F.col("grp") == "biblical_books", "b").when(F.col("grp") == "midrashic_rabbinic", "mi").alias("category")).where("category is not null")
    return etl.categorise(_refs(spark, d), books)


@query("WITH l AS (SELECT seq, list_concat(list_transform(coalesce(rf['t'], []), lambda x: {'category': 't', 'ref': x}), list_transform(coalesce(rf['b'], []), lambda x: {'category': 'b', 'ref': x}), list_transform(coalesce(rf['mi'], []), lambda x: {'category': 'mi', 'ref': x}), list_transform(coalesce(rf['o'], []), lambda x: {'category': 'o', 'ref': x})) AS a FROM entries WHERE rf IS NOT NULL), f AS (SELECT seq, list_filter(a, lambda x: x.ref IS NOT NULL) AS a FROM l), u AS (SELECT seq, unnest(a) AS x, generate_subscripts(a, 1) - 1 AS place FROM f) SELECT seq, CAST(place AS INTEGER) AS place, x.category, x.ref, place < 10 AS visible FROM u")
def shown_references(spark: SparkSession, d: str) -> DataFrame:
    return senses.shown_references(table(spark, d, "entries"))


# Validators, routes, display


@query(f"WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '^[{JS_WS}]+|[{JS_WS}]+$', '', 'g') AS t FROM documents), c AS (SELECT *, regexp_replace(t, '<[^>]*>', '', 'g') AS c FROM t), x AS (SELECT doc_id, c, CASE WHEN t = '' THEN 'Empty query' WHEN length(t) > 100 THEN 'Query too long (max 100 characters)' WHEN c = '' THEN 'Invalid query content' END AS error FROM c) SELECT doc_id, error IS NULL AS valid, CASE WHEN error IS NULL THEN c END AS query, error FROM x")
def query_validation(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", validate.clean_query(F.col("text")).alias("x")).select("doc_id", "x.*")


_URLS = [("#rid:A1",), ("https://texts.example/r/1",), ("http://www.texts.example:80/a?b#c",), ("https://texts.example.evil.org/",), ("https://nottexts.example",), ("javascript:alert(1)",), ("ftp://texts.example/",), ("",), (None,), ("HTTPS://TEXTS.EXAMPLE",), ("https://user@texts.example/x",)]


@query(f"SELECT url, coalesce(starts_with(url, '#') OR lower(regexp_extract(url, '(?i)^(https?)://(?:[^/?#@]*@)?([^/?#:@]+)(?::\\d+)?(?:[/?#].*)?$', 2)) = 'texts.example' OR ends_with(lower(regexp_extract(url, '(?i)^(https?)://(?:[^/?#@]*@)?([^/?#:@]+)(?::\\d+)?(?:[/?#].*)?$', 2)), '.texts.example'), false) AS allowed FROM (VALUES {_sql_values(_URLS)}) v(url)")
def url_allowlist(spark: SparkSession, d: str) -> DataFrame:
    return _values(spark, _URLS, "url string").select("url", validate.allowed_url(F.col("url"), "texts.example").alias("allowed"))


@query(f"WITH n AS (SELECT seq, try_cast(replace(regexp_extract(coalesce(p, ''), '^[{JS_WS}]*([+-]?[0-9]+)', 1), '+', '') AS BIGINT) AS n FROM entries), x AS (SELECT seq, n, CASE WHEN n IS NULL THEN 'Invalid page number' WHEN n < 1 OR n > 1704 THEN 'Page number must be between 1 and 1704' END AS error FROM n) SELECT seq, error IS NULL AS valid, CASE WHEN error IS NULL THEN n END AS page, error FROM x")
def page_validation(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entries").select("seq", validate.page_number(F.col("p")).alias("x")).select("seq", "x.*")


_HASHES = [("#sages", "sages", None), ("#sage:abba-x", "sage", "abba-x"), ("", "home", None), (None, "home", None), ("#guide", "home", "guide"), ("#abbreviations", "home", "abbreviations"), ("#word=אב_גד", "word", "אב גד"), ("#ref:Orvaya_28b", "reference", "Orvaya 28b"), ("#rid:A00001", "rid", "A00001"), ("#scan:500", "scan", "500"), ("#scan:9999", "none", None), ("#12", "page", "12"), ("#אבא", "word", "אבא"), ("#%D7%90", "word", "א"), ("#abc", "word", "abc"), ("#12a", "word", "12a"), ("#a+b", "word", "a+b"), ("#100%", "word", "100%")]


@query(f"SELECT hash, route, arg FROM (VALUES {_sql_values(_HASHES)}) v(hash, route, arg)")
def route_parse(spark: SparkSession, d: str) -> DataFrame:
    return _values(spark, [(h,) for h, _, _ in _HASHES], "hash string").select("hash", routes.parse_route(F.col("hash")).alias("x")).select("hash", "x.*")


@query(f"WITH {_E} SELECT seq, coalesce('#' || CAST(page AS VARCHAR), '#' || hw, '#rid:' || id, '') AS route FROM e")
def route_build(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("seq", routes.build_route(F.col("page"), F.col("hw"), F.lit(None).cast("string"), F.col("id")).alias("route"))


@query(f"WITH {_E}, n AS (SELECT DISTINCT page, CAST(page + 15 AS VARCHAR) AS n FROM e WHERE page IS NOT NULL) SELECT page, CASE WHEN length(n) < 4 THEN lpad(n, 4, '0') ELSE n END AS scan FROM n")
def scan_names(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).where("page is not null").select("page").distinct().select("page", display.scan_name(F.col("page")).alias("scan"))


_YEAR = "CASE WHEN dates.{0} IS NULL THEN '' WHEN dates.{0} < 0 THEN m || abs(dates.{0}) || ' BCE' ELSE m || dates.{0} || ' CE' END"


@query(f"WITH s AS (SELECT *, CASE WHEN coalesce(dates.approximate, false) THEN '~' ELSE '' END AS m FROM sages) SELECT pos, CASE WHEN dates.born IS NULL AND dates.died IS NULL THEN '' ELSE {_YEAR.format('born')} || ' – ' || {_YEAR.format('died')} END AS dates, CASE WHEN length(name.en) > 20 THEN left(name.en, 20) || '…' ELSE name.en END AS label FROM s")
def sage_labels(spark: SparkSession, d: str) -> DataFrame:
    return _sages(spark, d).select("pos", display.format_dates(F.col("dates.born"), F.col("dates.died"), F.col("dates.approximate")).alias("dates"), display.short_label(F.col("name.en")).alias("label"))


def _badge_rows() -> str:
    return _sql_values([(i, c, label, tip) for i, t in enumerate((display.LANGUAGES, display.SPEECH, display.GENDERS)) for c, (label, tip) in t.items()])


@query(f"WITH b AS (SELECT * FROM (VALUES {_badge_rows()}) v(place, code, label, tooltip)), c AS (SELECT seq, 0 AS place, g.l AS code FROM entries UNION ALL SELECT seq, 1, g.ps FROM entries UNION ALL SELECT seq, 2, g.gn FROM entries) SELECT seq, place, label, tooltip FROM c JOIN b USING (place, code)")
def badges(spark: SparkSession, d: str) -> DataFrame:
    return senses.badges(table(spark, d, "entries"))


@query()
def shown_senses(spark: SparkSession, d: str) -> DataFrame:
    return senses.shown_senses(table(spark, d, "entries"))


@query()
def entry_contents(spark: SparkSession, d: str) -> DataFrame:
    return senses.contents(table(spark, d, "entries"))


# Abbreviations


@query("WITH k AS (SELECT *, row_number() OVER (ORDER BY lower(strip_accents(key)), key) AS place, CASE WHEN starts_with(lower(key), 'orv') THEN 1 WHEN contains(lower(key), 'orv') THEN 2 WHEN contains(lower(key || ' ' || value), 'orv') THEN 3 END AS tier FROM lookup) SELECT key, value, tier FROM k WHERE tier IS NOT NULL ORDER BY tier, key LIMIT 1")
def best_abbreviation(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lookup").withColumn("text", display.search_text(F.col("key"), F.col("value")))
    return search.best_match(rows, "key", "text", "key", " Orv").select("key", "value", "tier")


@query("SELECT key, value, lower(coalesce(key, '') || ' ' || coalesce(value, '')) AS text FROM lookup")
def sorted_abbreviations(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lookup").select("key", "value", display.search_text(F.col("key"), F.col("value")).alias("text"))
    return rows.orderBy(F.collate("key", "UNICODE_CI_AI"), "key")


@query(f"{_D_TEXT}, a AS (SELECT seq, path, unnest(regexp_extract_all(d, '<a [^>]*>([^<]*)</a>', 1)) AS key FROM t), l AS (SELECT DISTINCT key, value FROM lookup) SELECT seq, path, key, value FROM a JOIN l USING (key)")
def abbreviation_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The texts of links in definitions that are abbreviations, with their full names."""
    marked = _definitions(spark, d).select("seq", "path", F.explode(F.regexp_extract_all("d", F.lit("<a [^>]*>([^<]*)</a>"), F.lit(1))).alias("key"))
    return marked.join(table(spark, d, "lookup").select("key", "value").distinct(), "key").select("seq", "path", "key", "value")


# The graph

_V = "v AS (SELECT * FROM sages s WHERE id IS NOT NULL AND pos = (SELECT max(pos) FROM sages z WHERE z.id = s.id))"
_D = "d0 AS (SELECT id AS src, pos, unnest(relationships) AS r, generate_subscripts(relationships, 1) - 1 AS ix FROM sages), d AS (SELECT src, r.target AS dst, r.type AS type, pos, ix FROM d0 WHERE r IS NOT NULL)"
_I = f"i AS (SELECT * FROM (VALUES {_sql_values(list(graph.INVERSE.items()))}) v(type, other))"
_A = "a AS (SELECT src, dst, type, pos, ix, false AS inverse FROM d UNION ALL SELECT d.dst, d.src, i.other, d.pos, d.ix, true FROM d JOIN i USING (type) WHERE d.dst IN (SELECT id FROM sages WHERE id IS NOT NULL))"
_G = "g AS (SELECT src, dst, type, pos, ix FROM (SELECT *, row_number() OVER (PARTITION BY least(src, dst), greatest(src, dst), type ORDER BY pos, ix, src, dst) AS n FROM d WHERE src IS NOT NULL AND dst IS NOT NULL) WHERE n = 1)"
_S = "s AS (SELECT * FROM v WHERE CASE WHEN era = 'tanna' THEN 'tanna' ELSE 'amorai-' || coalesce(location, 'null') END IN ('tanna', 'amorai-israel'))"
_VE = f"ve AS (SELECT src, dst, type, pos, ix FROM g WHERE type IN ({', '.join(repr(t) for c in graph.CLASSES.values() for t in c)}) AND src IN (SELECT id FROM s) AND dst IN (SELECT id FROM s))"
_H = "h AS (SELECT DISTINCT id FROM v WHERE nasi), nb AS (SELECT src AS id, dst AS near FROM a WHERE src IN (SELECT id FROM h) AND dst IS NOT NULL UNION SELECT id, id FROM h)"
_GROUPS = ("tanna", "amorai-israel")


def _chosen(spark: SparkSession, d: str) -> DataFrame:
    return graph.vertices(_sages(spark, d)).where("nasi").select("id")


@query("SELECT pos, id FROM sages WHERE contains(lower(name.en), lower('Of N')) OR contains(name.he, 'Of N')")
def sage_search(spark: SparkSession, d: str) -> DataFrame:
    return graph.search_names(_sages(spark, d), "Of N").select("pos", "id")


@query("SELECT pos, id FROM sages WHERE era = 'amorai'")
def sages_of_era(spark: SparkSession, d: str) -> DataFrame:
    return graph.of_era(_sages(spark, d), "amorai").select("pos", "id")


@query(f"WITH {_V} SELECT id, pos, era, location FROM v")
def graph_vertices(spark: SparkSession, d: str) -> DataFrame:
    return graph.vertices(_sages(spark, d)).select("id", "pos", "era", "location")


@query(f"WITH {_D}, {_I}, {_A} SELECT src, dst, type, inverse, count(*) AS n FROM a GROUP BY ALL")
def bidirectional_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.adjacency(_sages(spark, d)).groupBy("src", "dst", "type", "inverse").agg(F.count("*").alias("n"))


@query(f"WITH {_V}, {_D}, {_I}, {_A} SELECT a.src, a.type, count(*) AS n, list(a.dst ORDER BY a.pos, a.ix, a.inverse, a.dst) AS ids FROM a JOIN v ON v.id = a.dst GROUP BY a.src, a.type")
def grouped_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return graph.grouped_neighbours(_sages(spark, d)).select("src", "type", "n", "ids")


@query(f"WITH {_D}, {_G} SELECT src, dst, type FROM g")
def undirected_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.edges(_sages(spark, d)).select("src", "dst", "type")


@query(f"WITH {_V}, {_D}, {_G}, {_S}, {_VE} SELECT src, dst, type FROM ve")
def visible_subgraph(spark: SparkSession, d: str) -> DataFrame:
    return graph.visible_edges(_sages(spark, d), _GROUPS).select("src", "dst", "type")


@query(f"WITH {_V}, {_D}, {_I}, {_A}, {_S}, {_H} SELECT nb.id AS chosen, s.id, nb.id = s.id AS selected FROM nb JOIN s ON s.id = nb.near")
def highlight_nodes(spark: SparkSession, d: str) -> DataFrame:
    return graph.highlight_nodes(_sages(spark, d), _chosen(spark, d), _GROUPS)


@query(f"WITH {_V}, {_D}, {_I}, {_A}, {_G}, {_S}, {_VE}, {_H} SELECT x.id AS chosen, ve.src, ve.dst, ve.type FROM ve JOIN nb x ON x.near = ve.src JOIN nb y ON y.near = ve.dst AND y.id = x.id")
def highlight_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.highlight_edges(_sages(spark, d), _chosen(spark, d), _GROUPS)


@query(f"WITH {_D} SELECT 'era' AS kind, era AS value, count(*) AS n FROM sages GROUP BY era UNION ALL SELECT 'location', location, count(*) FROM sages GROUP BY location UNION ALL SELECT 'relationship', type, count(*) FROM d GROUP BY type")
def graph_statistics(spark: SparkSession, d: str) -> DataFrame:
    return graph.statistics(_sages(spark, d))


_MISSING = " UNION ALL ".join(f"SELECT id, pos, 'missing {c}' AS rule, NULL AS value FROM sages WHERE coalesce(CAST({c} AS VARCHAR), '') = ''" for c in ("id", "name.en", "name.he", "era", "generation", "location"))


@query(f"WITH {_D} {_MISSING} UNION ALL SELECT id, pos, 'unknown era', era FROM sages WHERE era <> '' AND era NOT IN ('tanna', 'amorai') UNION ALL SELECT id, pos, 'unknown location', location FROM sages WHERE location <> '' AND location NOT IN ('israel', 'bavel') UNION ALL SELECT src, pos, 'unknown target', dst FROM d WHERE dst IS NULL OR dst NOT IN (SELECT id FROM sages WHERE id IS NOT NULL) UNION ALL SELECT id, min(pos), 'repeated id', CAST(count(*) AS VARCHAR) FROM sages WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1")
def graph_violations(spark: SparkSession, d: str) -> DataFrame:
    return graph.violations(_sages(spark, d))


# The layout

_BANDS = "bn AS (SELECT era, generation, location, count(*) AS n FROM s GROUP BY ALL)"
_ROWS = f"ro AS (SELECT * FROM (VALUES {_sql_values([(e, g, i, y) for i, ((e, g), y) in enumerate(zip(layout.ROWS, layout.YEARS))])}) v(era, generation, n_row, year))"
_HEIGHTS = "he AS (SELECT ro.era, ro.generation, ro.n_row, ro.year, greatest(70, ceil(greatest(coalesce(max(CASE WHEN location IN ('israel', 'bavel') THEN n END), 0), 1) / 5) * 56) + 8 AS height FROM ro LEFT JOIN bn ON bn.era = ro.era AND bn.generation = ro.generation GROUP BY ALL), hy AS (SELECT *, 40 + coalesce(sum(height) OVER (ORDER BY n_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS y FROM he)"
_COLUMNS = "co AS (SELECT 30 AS bavel_x, 70 + greatest(coalesce(max(CASE WHEN location = 'bavel' THEN least(n, 5) END), 1) * 152, 300) AS israel_x FROM bn)"
_POSITIONS = f"{_BANDS}, {_ROWS}, {_HEIGHTS}, {_COLUMNS}, rk AS (SELECT id, era, generation, location, row_number() OVER (PARTITION BY era, generation, location ORDER BY coalesce(dates.born, 0), coalesce(name.en, ''), id) AS rank FROM s), po AS (SELECT rk.id, rk.era, rk.generation, rk.location, rank, CAST(CASE rk.location WHEN 'bavel' THEN bavel_x ELSE israel_x END + (rank - 1) % 5 * 152 AS BIGINT) AS x, CAST(y + ((rank - 1) // 5) * 56 AS BIGINT) AS y FROM rk JOIN hy ON hy.era = rk.era AND hy.generation = rk.generation, co WHERE rk.location IN ('bavel', 'israel'))"


@query(f"WITH {_V}, {_S}, {_POSITIONS} SELECT id, era, generation, location, rank, x, y FROM po")
def band_layout(spark: SparkSession, d: str) -> DataFrame:
    return layout.positions(_sages(spark, d), _GROUPS)


@query(f"WITH {_V}, {_S}, {_BANDS}, {_ROWS}, {_HEIGHTS} SELECT era, generation, CAST(y AS BIGINT) AS y, CAST(height AS BIGINT) AS height FROM hy")
def row_heights(spark: SparkSession, d: str) -> DataFrame:
    return layout.row_heights(graph.visible(_sages(spark, d), _GROUPS)).select("era", "generation", "y", "height")


@query(f"WITH {_V}, {_S}, {_POSITIONS} SELECT min(x) AS min_x, min(y) AS min_y, max(x) + 140 AS max_x, max(y) + 44 AS max_y FROM po")
def bounding_box(spark: SparkSession, d: str) -> DataFrame:
    return layout.bounding_box(layout.positions(_sages(spark, d), _GROUPS))


@query(f"WITH {_V}, {_S}, {_POSITIONS}, b AS (SELECT min(x) AS a, max(x) + 140 AS z, min(y) AS t FROM po), v1 AS (SELECT a, z, t, least(CAST(1200 AS DOUBLE) / (z - a + 40), 0.8) * 0.9 AS s FROM b) SELECT round(s, 6) AS scale, round(600 - (a + z) / 2 * s, 6) AS tx, round(20 - t * s, 6) AS ty FROM v1")
def initial_view(spark: SparkSession, d: str) -> DataFrame:
    view = layout.initial_view(layout.positions(_sages(spark, d), _GROUPS), 1200.0)
    return view.select(*(F.round(c, 6).alias(c) for c in ("scale", "tx", "ty")))


@query(f"WITH {_V}, {_D}, {_G}, {_S}, {_VE}, {_POSITIONS} SELECT src, dst, type, CAST(a.x + 70 AS DOUBLE) AS sx, CAST(a.y + 22 AS DOUBLE) AS sy, round((a.x + b.x + 140) / 2 + (b.y - a.y) * CAST(0.1 AS DOUBLE), 6) AS mx, CAST((a.y + b.y + 44) / 2 AS DOUBLE) AS my, CAST(b.x + 70 AS DOUBLE) AS tx, CAST(b.y + 22 AS DOUBLE) AS ty FROM ve JOIN po a ON a.id = src JOIN po b ON b.id = dst")
def edge_curves(spark: SparkSession, d: str) -> DataFrame:
    return layout.edge_curves(_sages(spark, d), _GROUPS).withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("sx", "sy", "mx", "my", "tx", "ty")})


@query(f"WITH {_V}, {_S}, {_BANDS}, {_ROWS}, {_HEIGHTS}, sp AS (SELECT year AS a, lead(year) OVER (ORDER BY n_row) AS b, y, lead(y) OVER (ORDER BY n_row) AS z FROM hy), q AS (SELECT DISTINCT dates.born AS year FROM sages WHERE dates.born IS NOT NULL) SELECT q.year, round(sp.y + (q.year - a) / (b - a) * (z - sp.y), 6) AS at FROM q LEFT JOIN sp ON q.year >= a AND q.year < b")
def year_heights(spark: SparkSession, d: str) -> DataFrame:
    years = _sages(spark, d).where("dates.born is not null").select(F.col("dates.born").alias("year")).distinct()
    return layout.year_heights(years, layout.row_heights(graph.visible(_sages(spark, d), _GROUPS))).withColumn("at", F.round("at", 6))


# Text stages

_LI = r"regexp_replace(lower(regexp_replace(coalesce(li, ''), '<[^>]*>', '', 'g')), '\s+', ' ', 'g')"


@query(f"WITH t AS (SELECT seq, {_LI} AS t FROM entries) SELECT seq, CASE WHEN regexp_matches(t, '(^|[^a-z])ch\\.') AND contains(t, '= h.') THEN 'ar+he' WHEN regexp_matches(t, '(^|[^a-z])ch\\.') AND contains(t, '= b.') THEN 'ar+bh' WHEN contains(t, 'h. a. ch.') OR contains(t, 'h. = ch.') THEN 'he+ar' WHEN regexp_matches(t, '(^|[^a-z])ch\\. = ') THEN 'ar' WHEN contains(t, 'b. h.') THEN 'bh' WHEN regexp_matches(t, '(^|[^a-z])ch\\.') THEN 'ar' WHEN regexp_matches(t, '(^|[^a-z])ar\\.') THEN 'ab' WHEN regexp_matches(t, '(^|[^a-z])h\\.') THEN 'he' END AS language FROM t")
def language_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entries").select("seq", etl.language(F.col("li")).alias("language"))


_RULES = " ".join(f"WHEN regexp_matches(t, '^{p}') THEN '{v}'" for p, v in ((r"pr\. n\. m\.", "n"), (r"pr\. n\. f\.", "n"), (r"[mf]\. pl\.", "n"), (r"interj\.", "ij"), (r"part\.", "pt"), (r"conj\.", "cj"), (r"adj\.", "a"), (r"adv\.", "av"), (r"[mfn]\.", "n"), (r"v\.", "v")))


@query(rf"{_D_TEXT}, v AS (SELECT DISTINCT seq FROM x UNION SELECT seq FROM n WHERE json_extract_string(e, '$.g.vs') IS NOT NULL OR json_extract_string(e, '$.grammar.verbal_stem') IS NOT NULL), f AS (SELECT seq, trim(regexp_replace(coalesce(t.d, ''), '<[^>]*>', '', 'g')) AS t, seq IN (SELECT seq FROM v) AS verb FROM entries LEFT JOIN (SELECT * FROM t WHERE path = '0') t USING (seq)) SELECT seq, CASE WHEN verb THEN 'v' {_RULES} END AS ps, CASE WHEN verb THEN NULL WHEN regexp_matches(t, '^(pr\. n\. m\.|m\. pl\.|m\.)') THEN 'm' WHEN regexp_matches(t, '^(pr\. n\. f\.|f\. pl\.|f\.)') THEN 'f' END AS gn FROM f")
def speech_tags(spark: SparkSession, d: str) -> DataFrame:
    """The tags of each entry by its stems and forms, else by the start of its first definition."""
    rows = flatten_senses(table(spark, d, "entries"), "c", "seq", text=True)
    first = rows.groupBy("seq").agg(F.max(F.when((F.col("kind") == "sense") & (F.col("path") == "0"), F.col("d"))).alias("d"), F.bool_or((F.col("kind") == "form") | F.col("vs").isNotNull()).alias("verb"))
    return table(spark, d, "entries").select("seq").join(first, "seq", "left").select("seq", etl.speech(F.col("d"), F.col("verb")).alias("x")).select("seq", "x.ps", "x.gn")


_LINKS_IN = "coalesce((length(c) - length(replace(c, '/Lexikon,_', ''))) // 10, 0)"


@query(f"SELECT seq, md5(regexp_replace(c, '<[^>]*>', '', 'g')) AS bare, coalesce((length(c) - length(replace(c, '<a ', ''))) // 3, 0) - {_LINKS_IN} AS anchors FROM entries")
def nested_links_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """After the clean-up: the trees without any tags, which it must not change, and the links that are left."""
    cleaned = etl.clean_nested_links(table(spark, d, "entries").select("seq", "part", "c"), "c", "Lexikon")[0]
    return cleaned.select("seq", F.md5(F.regexp_replace("c", "<[^>]*>", "")).alias("bare"), F.coalesce(display.occurrences(F.col("c"), "<a "), F.lit(0)).cast("bigint").alias("anchors"))


@query(f"WITH x AS (SELECT part, {_LINKS_IN} AS n FROM entries) SELECT part, count(*) FILTER (n > 0) AS entries_changed, CAST(sum(n) AS BIGINT) AS links_fixed, CAST(0 AS BIGINT) AS remaining FROM x GROUP BY ROLLUP (part)")
def nested_links_report(spark: SparkSession, d: str) -> DataFrame:
    """What the clean-up changed; the SQL counts the links and demands that none remains."""
    return etl.clean_nested_links(table(spark, d, "entries").select("part", "c"), "c", "Lexikon")[1]


@query("SELECT seq, " + "regexp_replace(" * len(etl.SHORT_KEYS) + "c" + "".join(f""", '([{{,\\s])"{long}"(\\s*:)', '\\1"{short}"\\2', 'g')""" for long, short in etl.SHORT_KEYS.items()) + " AS c FROM entries")
def keys_shortened(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entries").select("seq", etl.shorten_keys(F.col("c")).alias("c"))


@query(f"{_D_TEXT} SELECT seq, path, regexp_replace(d, '(?is)(<abbr\\b[^>]*?)\\stitle=(?:\"[^\"]*\"|''[^'']*'')', '\\1', 'g') AS d FROM t WHERE contains(d, '<abbr')")
def titles_stripped(spark: SparkSession, d: str) -> DataFrame:
    """The definitions with abbreviations, without the titles of these."""
    return _definitions(spark, d).where(F.contains("d", F.lit("<abbr"))).select("seq", "path", etl.strip_titles(F.col("d")).alias("d"))


_ALLOWED = " ".join(f"WHEN '{n}' THEN [{', '.join(repr(x) for x in sorted({*a, *etl.ANYWHERE}))}]" for n, a in etl.ATTRIBUTES.items())


#: Mark-up that breaks each rule, as the tables hold none that does.
_UNCLEAN = [(-1, '<script src="x">1</script>'), (-2, '<a href="javascript:alert(1)" onclick="f()">x</a><a HREF=" JavaScript:b">y</a>'), (-3, "<b style='c' class=d>x</b><IMG src=q>"), (-4, "a < b <unclosed"), (-5, None), (-6, '<abbr title="t" dir="rtl">ok</abbr>')]


@query(rf"""{_D_TEXT}, h AS (SELECT seq, d AS text FROM t UNION ALL SELECT seq, li FROM entries UNION ALL SELECT * FROM (VALUES {_sql_values(_UNCLEAN)}) v(seq, text)), mg AS (SELECT seq AS doc_id, unnest(regexp_extract_all(text, '(?s)</?[a-zA-Z][^>]*>?')) AS tag FROM h),
mn AS (SELECT doc_id, tag, lower(regexp_extract(tag, '^</?([a-zA-Z0-9]+)', 1)) AS name FROM mg),
a AS (SELECT *, CASE name {_ALLOWED} ELSE ['class', 'dir'] END AS ok, list_transform(regexp_extract_all(regexp_replace(tag, '=\s*("[^"]*"|''[^'']*''|[^\s>]+)', '=', 'g'), '\s([a-zA-Z_:][a-zA-Z0-9_:.-]*)', 1), lambda x: lower(x)) AS names, regexp_replace(regexp_extract(tag, '(?is)\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1), '^["'']|["'']$', '', 'g') AS href FROM mn),
v AS (SELECT doc_id, 'tag' AS rule, name AS value FROM a WHERE name NOT IN ({', '.join(map(repr, etl.TAGS))})
UNION ALL SELECT doc_id, 'attribute', name || '.' || x FROM (SELECT doc_id, name, unnest(list_distinct(list_filter(names, lambda y: NOT list_contains(ok, y)))) AS x FROM a)
UNION ALL SELECT doc_id, 'address', href FROM a WHERE starts_with(lower(trim(href)), 'javascript:'))
SELECT doc_id AS seq, rule, value, count(*) AS n FROM v GROUP BY ALL""")
def markup_violations(spark: SparkSession, d: str) -> DataFrame:
    """Over the definitions at all depths and the language lines, and a few texts that break each rule."""
    html = _definitions(spark, d).select("seq", F.col("d").alias("text")).unionByName(table(spark, d, "entries").select("seq", F.col("li").alias("text"))).unionByName(_values(spark, _UNCLEAN, "seq long, text string"))
    return etl.markup_violations(html, "seq", "text")


@query()
def abbreviations_marked(spark: SparkSession, d: str) -> DataFrame:
    """Definitions in which known abbreviations are marked; the list is proven to be short before it becomes a pattern."""
    keys = table(spark, d, "lookup").select("key").distinct()
    if not bounded(keys, 10_000):
        raise ValueError("more than 10000 abbreviations")
    known = [r["key"] for r in keys.collect()]
    return _definitions(spark, d).select("seq", "path", etl.mark_abbreviations(F.col("d"), known).alias("d"))


@query("SELECT seq, CASE WHEN len(pf) > 0 THEN pf END AS pf, CASE WHEN len(ah) > 0 THEN ah END AS ah FROM entries")
def fields_stripped(spark: SparkSession, d: str) -> DataFrame:
    return etl.strip_fields(table(spark, d, "entries")).select("seq", "pf", "ah")


@query(f"""{_D_TEXT}, w AS (SELECT DISTINCT seq, unnest(regexp_extract_all(d, 'href="#([^":]+)" class="word-link"', 1)) AS target FROM t), i AS (SELECT hw, arg_min(id, seq) AS id FROM entries WHERE hw IS NOT NULL AND id IS NOT NULL GROUP BY hw) SELECT w.seq, w.target, i.id FROM w LEFT JOIN i ON i.hw = w.target""")
def word_links(spark: SparkSession, d: str) -> DataFrame:
    """Word links by headword, with the entry they lead to (null: unresolved)."""
    entries = table(spark, d, "entries")
    held = sense_texts(entries, "c", "seq", containing="word-link")
    links = held.select("seq", F.explode(F.flatten(F.transform("texts", lambda t: F.regexp_extract_all(t, F.lit('href="#([^":]+)" class="word-link"'), F.lit(1))))).alias("target"))
    return etl.resolve_word_links(links.distinct(), entries)


# Annotations, changes, history, quality


@query("SELECT seq, id FROM entries e WHERE nullif(g.ps, '') IS NULL AND NOT EXISTS (SELECT 1 FROM annotations a WHERE a.rid = e.id AND a.type = 'needs-review' AND starts_with(a.note, 'AI suggests:'))")
def unannotated(spark: SparkSession, d: str) -> DataFrame:
    return annotate.unannotated(table(spark, d, "entries"), table(spark, d, "annotations")).select("seq", "id")


_DEFINITION = "CASE WHEN json_valid(c) THEN coalesce(json_extract_string(j, '$.s[0].d'), json_extract_string(j, '$.s.d'), json_extract_string(j, '$.senses[0].definition'), json_extract_string(j, '$.senses.definition'), json_extract_string(j, '$[0].d'), json_extract_string(j, '$[0].definition')) END"


@query(f"WITH j AS (SELECT *, CASE WHEN json_valid(c) THEN CASE WHEN json_type(c) = 'VARCHAR' THEN json_extract_string(c, '$') ELSE c END END AS j FROM entries WHERE nullif(g.ps, '') IS NULL), l AS (SELECT seq, 'RID: ' || coalesce(id, '') || ' | Headword: ' || coalesce(hw, '') || ' | Language: ' || coalesce(nullif(g.l, ''), '?') || ' | Definition: ' || left(coalesce({_DEFINITION}, ''), 200) AS line, (row_number() OVER (ORDER BY seq) - 1) // 20 AS batch FROM j) SELECT batch, count(*) AS n, string_agg(line, chr(10) ORDER BY seq) AS prompt FROM l GROUP BY batch")
def batch_prompts(spark: SparkSession, d: str) -> DataFrame:
    return annotate.batches(annotate.first_definition(annotate.missing_speech(table(spark, d, "entries"))))


@query("SELECT ann_id, note FROM annotations WHERE note IS DISTINCT FROM 'check the column'")
def notes_dropped(spark: SparkSession, d: str) -> DataFrame:
    return annotate.drop_notes(table(spark, d, "annotations"), "check the column").select("ann_id", "note")


@query("SELECT ann_id, rid, CASE WHEN note IS NULL THEN 'none' ELSE note END AS note FROM annotations")
def bulk_update(spark: SparkSession, d: str) -> DataFrame:
    notes = table(spark, d, "annotations").select("ann_id", "rid", "note")
    return crud.update_rows(notes, notes.where("note is null").withColumn("note", F.lit("none")), "ann_id")


_TARGETS = "SELECT unnest(relationships).target AS id FROM sages"


@query(f"WITH t AS ({_TARGETS}), c AS (SELECT id, count(*) AS n FROM t GROUP BY id), j AS (SELECT *, CASE WHEN coalesce(id, '') = '' THEN 400 WHEN id IN (SELECT id FROM sages WHERE id IS NOT NULL) THEN 409 ELSE 201 END AS s FROM c) SELECT id, s AS status, CASE s WHEN 201 THEN 1 ELSE n END AS n FROM j UNION ALL SELECT id, 409, n - 1 FROM j WHERE s = 201 AND n > 1")
def insert_unique(spark: SparkSession, d: str) -> DataFrame:
    sages = _sages(spark, d)
    return crud.insert_rows(sages.select("id"), sages.select(F.explode("relationships.target").alias("id")))[1]


@query("SELECT e.seq, e.id FROM entries e WHERE NOT EXISTS (SELECT 1 FROM removals r WHERE r.tbl = 'entries' AND r.rid = e.id) OR e.seq > (SELECT min(seq) FROM entries f WHERE f.id = e.id)")
def delete_first(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "removals").where("tbl = 'entries'").select(F.col("rid").alias("id"))
    return crud.delete_first(table(spark, d, "entries").select("seq", "id"), gone)[0]


@query("WITH u AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, max(struct_pack(t := ts, e := event_id)) AS x FROM events GROUP BY ALL), r AS (SELECT user_id, event_type, day, x.e AS event_id, row_number() OVER (PARTITION BY user_id ORDER BY x.t DESC, x.e DESC) AS rank FROM u) SELECT user_id, event_type, day, event_id, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20")
def search_history(spark: SparkSession, d: str) -> DataFrame:
    uses = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return history.history(uses, "user_id", ["event_type", "day"], "ts", "event_id").select("user_id", "event_type", "day", "event_id", "rank")


@query("WITH n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events) SELECT event_id FROM n WHERE nx IS NULL OR nx - ts >= INTERVAL 24 HOUR")
def debounced(spark: SparkSession, d: str) -> DataFrame:
    return annotate.edges_of_bursts(table(spark, d, "events"), "user_id", "ts", gap_ms=86_400_000).select("event_id")


_CHECKED = ("id", "hw", "p", "col", "li", "c", "rf", "ah", "pf", "q", "mo")


@query("SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in _CHECKED) + " FROM entries")
def quality_dashboard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entries").agg(F.count("*").alias("total"), *(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in _CHECKED))


@query(f"WITH {_R} SELECT seq, ref, norm FROM r")
def normalize_references(spark: SparkSession, d: str) -> DataFrame:
    return _refs(spark, d).select("seq", "ref", normalize_reference(F.col("ref")).alias("norm"))
