"""Lookups: quirks on small fixtures, and batches against brute force."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from lexigraph.functions.display import counted, curve, fit_view, format_dates, json_in_text, occurrences, progress, prompt_line, scan_name, sense_number, short_label, suggestion, zoomed
from lexigraph.functions.normalize import normalize_hebrew, normalize_reference
from lexigraph.functions.routes import build_route, parse_route, rewrite_legacy_links
from lexigraph.functions.validate import allowed_url, clean_query, page_number
from lexigraph.lexicon import Lexicon
from lexigraph.operators import index, paging, search
from lexigraph.operators.history import history
from lexigraph.operators.ranking import ranked

WORDS = [(0, "A1", "אָב I", "1"), (1, "A2", "אב II", "1"), (2, "A3", "אבן", "2"), (3, "A3", "גם", "2"), (4, None, None, None), (5, "A5", "ABC", "0"), (6, "A6", "דד", " 3"), (7, "", "דדד", "3x")]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


@pytest.fixture(scope="module")
def lexicon(spark):
    rf = [{"t": ["X 1", "X 1:5"], "o": ["X 1"]}, {"t": ["X 10", "x. 1 a"]}, {}, None, None, {"b": [None, "Y ﻿ 2."]}, {"b": []}, {"b": ["X 1b"]}]
    return Lexicon(spark.createDataFrame([(*w, r) for w, r in zip(WORDS, rf)], "seq long, id string, hw string, p string, rf map<string,array<string>>"))


def test_normal_forms(spark):
    assert column(spark, ["אָבּך III", "שׁלום*", "abc", "", None, "ףץןםך"], normalize_hebrew) == ["אבכ", "שלומ", "", "", "", "פצנמכ"]
    assert column(spark, ["Ber. 2a", " B.  Kam.﻿ 5 ", "", None, " x\n\ny"], normalize_reference) == ["ber 2a", "b kam 5", "", None, "x y"]


def test_points_and_pages(spark, lexicon):
    ids = spark.createDataFrame([("A3",), ("A1",), ("A1",), ("zz",), ("",), (None,)], "id string")
    assert {(r.id, r.seq) for r in lexicon.by_id(ids).collect()} == {("A3", 3), ("A1", 0)}
    assert {tuple(r) for r in lexicon.ordinal(ids).collect()} == {("A3", 3), ("A1", 0), ("zz", -1), ("", 7), (None, -1)}
    assert [r.seq for r in lexicon.page(1).collect()] == [0, 1]
    assert lexicon.page_start(2).first()[0] == 2 and lexicon.page_start(99).first()[0] == -1
    assert [r.seq for r in lexicon.range(-3, 2).collect()] == [0, 1] and lexicon.range(100, 5).count() == 0 and lexicon.range(6, 50).count() == 2
    assert [r.seq for r in lexicon.window(2).collect()] == [2, 3, 4, 5, 6, 7] and lexicon.window(99).count() == 0 and lexicon.window(99, 6).count() == 2
    assert lexicon.count() == 8
    assert paging.forward(95, 100) == (95, 5) and paging.backward(20) == (0, 20) and paging.resident(0, 300, "forward") == (50, 300) and paging.resident(0, 300, "backward") == (0, 250)


def test_prefixes(spark, lexicon):
    assert [(r.norm, r.hw) for r in lexicon.prefix_headwords("אב").collect()] == [("אב", "אָב I"), ("אבנ", "אבן")]
    assert lexicon.prefix_headwords("xyz").count() == 0 and lexicon.prefix_headwords("אב", 1).count() == 1
    got = lexicon.prefix_headwords(spark.createDataFrame([("ד",), ("abc",), (None,)], "query string")).collect()
    assert [(r.query, r["rank"], r.norm) for r in sorted(got)] == [("ד", 1, "דד"), ("ד", 2, "דדד")]
    assert [r.ref for r in lexicon.prefix_references("x 1").collect()] == ["X 1", "x. 1 a", "X 10", "X 1:5", "X 1b"]
    assert [r.ref for r in lexicon.prefix_references("x 1", 2).collect()] == ["X 1", "x. 1 a"]
    assert lexicon.prefix_references(" . ").count() == 0


def test_stored_keys_are_pushed_down(spark, lexicon, tmp_path):
    lexicon.store(str(tmp_path / "keyed"))
    stored = Lexicon.from_store(spark, str(tmp_path / "keyed"))
    found = stored.entries.where(F.col("norm").startswith("אב"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(norm,אב)" in plan and found.count() == 3
    assert [r.norm for r in stored.prefix_headwords("אב").collect()] == ["אב", "אבנ"]
    narrow = stored.entries.where("seq between 2 and 3").select("hw")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seq,2)" in narrow and "ReadSchema: struct<seq:bigint,hw:string>" in narrow


def test_reference_boundary(spark, lexicon):
    assert [r.seq for r in lexicon.by_reference("X. 1").collect()] == [0, 1]
    assert [r.seq for r in lexicon.by_reference("y 2").collect()] == [5] and lexicon.by_reference("").count() == 0
    got = lexicon.by_reference(spark.createDataFrame([("X 1",), ("X",), ("Y",), ("",)], "query string")).collect()
    assert {tuple(r) for r in got} == {("X 1", 0), ("X 1", 1), ("X", 0), ("X", 1), ("X", 7), ("Y", 5)}


def test_nearest(spark, lexicon):
    assert {r.norm for r in lexicon.nearest("אבא").collect()} == {"אבנ"}
    assert {r.norm for r in lexicon.nearest("תת").collect()} == {"דדד"} and {r.norm for r in lexicon.nearest("x").collect()} == {""}
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("אבגדתש") for _ in range(rng.randint(0, 3)))
    keys, queries = sorted({word() for _ in range(40)}), [word() for _ in range(60)] + ["ת" * 5, ""]
    entries = spark.createDataFrame([(k,) for k in keys], "norm string")
    got = dict(map(tuple, search.nearest_batch(entries, spark.createDataFrame([(q,) for q in queries], "query string")).collect()))
    assert got == {q: keys[min(bisect.bisect_left(keys, q), len(keys) - 1)] for q in queries}
    assert search.nearest_batch(entries.limit(0), spark.createDataFrame([("א",)], "query string")).collect()[0]["key"] is None


def test_indexes(spark, lexicon):
    assert {(r.norm, r.n, r["first"], r["last"]) for r in index.key_index(lexicon.entries, "norm").collect()} == {("אב", 2, 0, 1), ("אבנ", 1, 2, 2), ("גמ", 1, 3, 3), ("", 2, 4, 5), ("דד", 1, 6, 6), ("דדד", 1, 7, 7)}
    assert {(r.page, r.n) for r in index.key_index(lexicon.entries, "page").collect()} == {(1, 2), (2, 2), (3, 1)}
    refs = index.sorted_references(lexicon.refs).collect()
    assert [(r.ref, r.first_seq) for r in refs] == [("X 1", 0), ("x. 1 a", 1), ("X 10", 1), ("X 1:5", 0), ("X 1b", 7), ("Y ﻿ 2.", 5)]


@pytest.mark.parametrize("span", [2, 3, 1_000_000])
def test_neighbours_across_spans(spark, lexicon, monkeypatch, span):
    monkeypatch.setattr(index, "SPAN", span)
    hw = [w[2] for w in WORDS]
    want = {(i, hw[i - 1] if i else None, hw[i + 1] if i < 7 else None) for i in range(8)}
    assert {tuple(r) for r in index.neighbours(lexicon.entries).collect()} == want


def test_ranked(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 9), i) for i in range(300)]
    got = ranked(spark.createDataFrame(rows, "g string, v long, i long"), ["g"], [F.col("v"), F.col("i")]).collect()
    want = {}
    for g in {r[0] for r in rows}:
        want.update({r[2]: n for n, r in enumerate(sorted(x for x in rows if x[0] == g), 1)} if g else {r[2]: n for n, r in enumerate(sorted((x[1], x[2], x) for x in rows if x[0] is None), 1) for r in [r[2]]})
    assert {r.i: r["rank"] for r in got} == want


def test_best_match_and_cap(spark):
    rows = spark.createDataFrame([(1, "x. Ber", "zz"), (2, "Berak.", "q"), (3, "B.", "has ber in it"), (4, None, None)], "o int, term string, text string")
    assert search.best_match(rows, "term", "text", "o", " ber ").first().o == 2
    assert search.best_match(rows, "term", "text", "o", "x. b").first().o == 1 and search.best_match(rows, "term", "text", "o", "has").first().o == 3
    assert search.best_match(rows, "term", "text", "o", "nothing").count() == 0 and search.best_match(rows, "term", "text", "o", "  ").count() == 0
    page, rest = search.capped(rows, "o", 2, 1)
    assert [r.o for r in page.collect()] == [2, 3] and tuple(rest.first()) == (4, 1)


def test_history(spark):
    uses = [(1, f"q{i % 22}", i, i) for i in range(30)] + [(2, "x", 5, 1), (2, "x", 5, 2), (2, None, 1, 3)]
    got = history(spark.createDataFrame(uses, "u int, q string, at int, id int"), "u", ["q"], "at", "id").collect()
    mine = sorted(((r["rank"], r.q, r["at"]) for r in got if r.u == 1))
    assert len(mine) == 20 and mine[0] == (1, "q7", 29) and mine[19] == (20, "q10", 10)
    assert sorted((r["rank"], r.q, r.id) for r in got if r.u == 2) == [(1, "x", 2), (2, None, 3)]


def test_validators(spark):
    pages = column(spark, ["12abc", " 7", "0", "1705", "x", None, "+5", "-1", "9" * 60, "﻿3"], lambda c: page_number(c).page)
    assert pages == [12, 7, None, None, None, None, 5, None, None, 3]
    assert column(spark, ["0", "x"], lambda c: page_number(c).error) == ["Page number must be between 1 and 1704", "Invalid page number"]
    assert column(spark, ["  a <b>b</b> ", "<i></i>", "", None, "x" * 101, "x" * 100], lambda c: clean_query(c).error) == [None, "Invalid query content", "Empty query", "Empty query", "Query too long (max 100 characters)", None]
    assert column(spark, ["  a <b>b</b> "], lambda c: clean_query(c)["query"]) == ["a b"]
    assert column(spark, ["#x", "https://a.b.org/x", "http://b.org:8080", "https://xb.org", "https://b.org.evil", "javascript:b.org", None, "//b.org"], lambda c: allowed_url(c, "b.org")) == [True, True, True, False, False, False, False, False]


def test_routes(spark):
    assert column(spark, ["#word=a_b", "rid:A1", "#scan:0", "#%zz", None], lambda c: F.concat_ws("|", parse_route(c).route, parse_route(c).arg)) == ["word|a b", "rid|A1", "none", "word|%zz", "home"]
    n = F.lit(None).cast("string")
    assert [one(spark, build_route(p, w, r, i)) for p, w, r, i in ((F.lit(5), F.lit("x"), n, n), (n, F.lit("x"), n, n), (n, n, F.lit("a b c"), n), (n, n, n, F.lit("A1")), (n, n, n, n))] == ["#5", "#x", "#ref:a_b_c", "#rid:A1", ""]
    html = '<a href="/Book,_*אב.1" target="_blank">x</a> <a target="_blank" href="/Book,_ב">y</a> <a href="/Other,_x" target="_blank">z</a>'
    assert one(spark, rewrite_legacy_links(F.lit(html), "Book")) == '<a href="#word=אב">x</a> <a href="#word=ב">y</a> <a href="/Other,_x" target="_blank">z</a>'


def test_display(spark):
    i = lambda x: F.lit(x).cast("int")
    dates = [one(spark, format_dates(i(b), i(d), F.lit(a).cast("boolean"))) for b, d, a in ((-110, 10, True), (50, 90, None), (None, None, True), (50, None, False))]
    assert dates == ["~110 BCE – ~10 CE", "50 CE – 90 CE", "", "50 CE – "]
    assert [one(spark, scan_name(F.lit(p))) for p in (1, 985, 99990)] == ["0016", "1000", "100005"]
    assert column(spark, ["— 2) ", "-a", "3)", None], sense_number) == ["2) ", "a", "3)", None]
    assert column(spark, ["x" * 20, "x" * 21, None], short_label) == ["x" * 20, "x" * 20 + "…", None]
    assert [one(spark, counted(F.lit(n))) for n in (0, 1, 2)] == ["0 results", "1 result", "2 results"]
    assert tuple(one(spark, curve(F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(50.0)))) == (70.0, 22.0, 125.0, 47.0, 170.0, 72.0)
    assert tuple(one(spark, fit_view(F.lit(100.0), F.lit(100.0), F.lit(200.0), F.lit(50.0)))) == (0.45, 5.0, 38.75)
    assert one(spark, zoomed(F.lit(1.0), F.lit(-1))) == pytest.approx(1 / 1.3) and one(spark, progress(F.lit(1), F.lit(0.5), F.lit(2))) == 75.0 and one(spark, progress(F.lit(3), F.lit(0.5), F.lit(2))) == 100.0
    assert one(spark, prompt_line(F.lit("A1"), F.lit("x"), F.lit(""), F.lit("d" * 300))) == "RID: A1 | Headword: x | Language: ? | Definition: " + "d" * 200
    assert column(spark, ["a [1] b [2] c", "none"], json_in_text) == ["[1] b [2]", ""]
    assert column(spark, ["m", "null", None, ""], lambda c: suggestion(F.lit("n"), c)) == ["AI suggests: ps=n, gn=m"] + ["AI suggests: ps=n"] * 3
    assert column(spark, ["aaaa", None, "b"], lambda c: occurrences(c, "aa")) == [2, 0, 0]
