"""Pieces and mixtures: exact round trips, limits, shares."""

import collections
import itertools
import os
import random
import re
import time

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from lexigraph.llm.encode import default_vocabulary, vocabulary
from lexigraph.llm.mix import mix, shares, short_sources, sized, source_key, supply
from lexigraph.llm.split import cutting_pattern, split_texts
from test_encode import encoded

pytestmark = pytest.mark.skipif(not os.path.exists(default_vocabulary()), reason="no tokenizer files")


def pieces_of(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = collections.defaultdict(list)
    for r in split_texts(df, "text", "id", **kw).collect():
        out[r.id].append(r)
    return {k: sorted(v, key=lambda r: r.piece_no) for k, v in out.items()}


def check(pieces, text, limit, overlap):
    """Each piece is the tokens of the text from ``overlap`` before the end of the piece before; together they are the text."""
    assert [p.piece_no for p in pieces] == list(range(len(pieces))) and {p.n_pieces for p in pieces} == {len(pieces)}
    voc = vocabulary(default_vocabulary())
    word = {i: w for w, i in voc.ranks.items()}
    ends = [0, *itertools.accumulate(len(word[i]) for i in encoded([text])[0])]
    raw, cut, start = text.encode(), 0, -1
    for p in pieces:
        assert 0 <= p.overlap <= overlap and cut - p.overlap >= start
        start = cut - p.overlap
        body = p.text.encode()
        end = ends[start] + len(body)
        assert raw[ends[start] : end] == body and end in ends and ends.index(end) > cut
        cut = ends.index(end)
        assert cut - start <= limit
    assert ends[cut] == len(raw)
    assert all(p.n_tokens == n <= limit for p, n in zip(pieces, map(len, encoded([p.text for p in pieces]))))


def test_pieces(spark):
    rng = random.Random(3)
    words = ["alpha", "beta.", "gamma!", "אבגד", "it's", "x", "\n\n", "\n", "  ", "דה׃", "😀"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 5, 60, 300, 1000)]
    texts += ["x" * 3000, "אבגד" * 400, "!'" * 400, "'" * 500, " " * 900, "\n" * 700, "😀" * 200, "a" * 40 + " " + "b" * 4000]
    for limit, overlap in ((32, 6), (16, 0), (64, 60)):
        got = pieces_of(spark, texts, limit=limit, overlap=overlap)
        for i, text in enumerate(texts):
            if not text:
                assert i not in got
            elif len(encoded([text])[0]) <= limit:
                assert [p.text for p in got[i]] == [text]
            else:
                check(got[i], text, limit, overlap)


def test_many_pieces_in_blocks(spark):
    """More pieces than a block, short parts among them, so that overlaps reach over several parts and over blocks."""
    rng = random.Random(8)
    text = "".join(rng.choice(["a ", "word ", "longer. ", "q" * rng.randint(1, 90), "\n\n"]) for _ in range(4500))
    for limit, overlap in ((16, 7), (24, 20)):
        got = pieces_of(spark, [text], limit=limit, overlap=overlap)[0]
        assert len(got) > 300
        check(got, text, limit, overlap)


def test_time_is_linear(spark):
    """Ten times the text takes about ten times as long, at 3 and 30 MB in one row."""
    unit = "".join(f"word{i % 97} and the {i % 89}th. " + ("\n\n" if i % 50 == 0 else "") for i in range(5_000))
    took = {}
    for size in (1, 1, 3, 30):
        df = spark.createDataFrame([(1, unit)], "id long, text string").select("id", F.repeat("text", F.lit(size * 1_000_000 // len(unit))).alias("text"))
        began = time.perf_counter()
        n, tokens, most = split_texts(df, "text", "id").selectExpr("count(*)", "sum(n_tokens - overlap)", "max(n_tokens)").first()
        took[size] = time.perf_counter() - began
        assert n > size * 300 and most <= 512
    assert took[30] <= 11 * max(took[3], 1.0), took


def test_natural_boundaries(spark):
    text = "\n\n".join(" ".join(["word"] * 9) + "." for _ in range(12))
    got = pieces_of(spark, [text], limit=40, overlap=6)[0]
    assert len(got) > 2 and all(p.text.endswith("\n\n") for p in got[:-1]) and all(p.overlap == 6 for p in got[1:])
    lines = pieces_of(spark, [" ".join(["word"] * 300)], limit=40, overlap=6)[0]
    assert all(re.fullmatch(r" ?word( word)*", p.text) for p in lines)


def test_nulls_repeats_clashes(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "a b " * 100, 7), (3, "a b " * 100, 7)], "id long, body string, n long")
    got = split_texts(df, "body", "id", "n", limit=64, overlap=8).collect()
    assert {r.id for r in got} == {3} and len(got) == 2 * got[0].n_pieces and {r.n for r in got} == {7}
    assert split_texts(df.limit(0), "body", "id").count() == 0
    clash = df.withColumnRenamed("body", "text").withColumnRenamed("n", "overlap")
    assert split_texts(clash, "text", "id", "text", "overlap", limit=64, overlap=8).count() == len(got)
    with pytest.raises(ValueError):
        split_texts(df, "body", "id", limit=5, overlap=5)
    assert re.match(cutting_pattern(4, 1), "wwww")[0] == "wwww"


def test_found(spark, duck):
    from lexigraph.llm.queries import p8_found

    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    want = {i for (i, _), n in zip(rows, map(len, encoded([t or "" for _, t in rows]))) if n > 512}
    assert {r.doc_id for r in p8_found(spark, DATA).collect()} == want


TARGETS = [("big one", 0.5, 1), ("small", 0.3, 2), ("rare", 0.1, 3), ("none", 0.1, 2)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    rows = [(i, "Big-One " if i % 7 else "BIG one", " ".join(["word"] * rng.randint(1, 30)) + f" {i}") for i in range(600)]
    rows += [(1000 + i, "small", f"text {i} " * 8) for i in range(120)] + [(2000 + i, "rare", f"r {i}") for i in range(10)]
    rows += [(3000, "small", "copy " * 50), (3001, "small", "copy " * 50), (3002, "big one", "copy " * 50), (4000, None, "x"), (4001, "other", "y"), (4002, "small", None), (4003, "small", "")]
    return spark.createDataFrame([(i, s and s.replace(" one", "_one"), t) for i, s, t in rows], "doc_id long, source string, text string").repartition(5)


@pytest.fixture(scope="module")
def targets(spark):
    return spark.createDataFrame([(s.replace(" ", "_"), w, m) for s, w, m in TARGETS], "source string, weight double, max_repeats int")


def test_supply(docs, targets):
    rows = docs.collect()
    tokens = collections.Counter()
    for r, n in zip(rows, map(len, encoded([r.text or "" for r in rows]))):
        if r.source and r.source != "other":
            tokens[r.source.strip().lower().replace("-", "_")] += n
    got = {r.source: r for r in supply(sized(docs, targets), targets).collect()}
    assert {s: r.tokens for s, r in got.items()} == {"big_one": tokens["big_one"], "small": tokens["small"], "rare": tokens["rare"], "none": 0}
    total = sum(tokens.values())
    assert {s: r.reached for s, r in got.items()} == {s.replace(" ", "_"): tokens[s.replace(" ", "_")] * m >= w * total for s, w, m in TARGETS}


@pytest.mark.parametrize("schedule", [None, {"small": [(0.0, 1.8), (1.0, 0.2)]}])
def test_mix(docs, targets, schedule):
    got = mix(docs, targets, schedule).collect()
    at = [r.position for r in got]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    uses = collections.Counter(r.doc_id for r in got)
    most = {"big_one": 1, "small": 2, "rare": 3}
    assert all(n <= most[next(r.source for r in got if r.doc_id == i)] for i, n in uses.items())
    text = {r.doc_id: r.text for r in docs.collect()}
    copies = [i for i in uses if text[i] == "copy " * 50]
    assert copies in ([], [3000]) and not {4000, 4001, 4002, 4003} & set(uses)
    wanted = {r.source: r.wanted for r in supply(sized(docs, targets), targets).collect()}
    used = collections.Counter()
    for r in got:
        used[r.source] += r.n_tokens
    longest = max(r.n_tokens for r in got)
    for s in ("big_one", "small"):
        assert abs(used[s] - wanted[s]) <= longest
    assert all(n == 3 for i, n in uses.items() if 2000 <= i < 3000) and sum(1 for i in uses if 2000 <= i < 3000) == 10
    end = {s: max(r.position for r in got if r.source == s) for s in used}
    assert end["rare"] < 0.9 and end["big_one"] > 0.95 and end["small"] > (0.8 if schedule else 0.95)
    half = sum(r.n_tokens for r in got if r.source == "small" and r.position < 0.5) / used["small"]
    assert abs(half - (0.7 if schedule else 0.5)) < 0.05
    report = {r.source: r for r in shares(mix(docs, targets, schedule), targets).collect()}
    assert report["rare"].most_uses == 3 and report["none"].uses == 0 and abs(sum(r.share for r in report.values()) - 1) < 1e-9


def test_short_sources_run_out(spark, docs, targets):
    """Those found from the placed corpus are those whose tokens do not suffice, and their shares are what they had."""
    for weights in ((0.5, 0.3, 0.1, 0.1), (0.05, 0.9, 0.05, 0.0), (0.9, 0.05, 0.05, 0.0)):
        own = spark.createDataFrame([(s.replace(" ", "_"), w, m) for (s, _, m), w in zip(TARGETS, weights)], "source string, weight double, max_repeats int")
        need = {r.source: r for r in supply(sized(docs, own), own).collect()}
        corpus = mix(docs, own, every=True)
        short = {r.source: r for r in short_sources(corpus, own).collect()}
        assert set(short) == {s for s, r in need.items() if not r.reached}
        assert all(r.given == need[s].tokens * next(m for t, _, m in TARGETS if t.replace(" ", "_") == s) for s, r in short.items())
        report = {r.source: r for r in shares(corpus, own).collect()}
        for s, r in need.items():
            if r.reached and r.wanted:
                assert 0 <= report[s].tokens - r.wanted < 60


def test_many_targets_are_joined(monkeypatch, docs, targets):
    from lexigraph.llm import mix as module

    want = sorted(map(tuple, mix(docs, targets).collect()))
    monkeypatch.setattr(module, "BROADCAST_ROWS", 2)
    assert sorted(map(tuple, mix(docs, targets).collect())) == want


def test_mix_of_nothing(spark, docs, targets):
    assert short_sources(mix(docs.limit(0), targets), targets).count() == 0
    assert mix(docs.limit(0), targets).count() == 0
    assert {r.reached for r in supply(sized(docs.limit(0), targets), targets).collect()} == {True}
    with pytest.raises(ValueError):
        mix(docs, targets, {"small": [(0.0, 1.0), (0.5, 1.0)]})
    keys = spark.createDataFrame([(" Big-One ",), ("BIG_ONE",), (None,)], "s string")
    assert [r[0] for r in keys.select(source_key(keys.s)).collect()] == ["bigone", "bigone", None]
