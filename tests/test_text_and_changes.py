"""Text stages, keyed changes, annotations, senses as shown, sources and streams on small fixtures."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexigraph.operators import annotate, crud, etl, senses
from lexigraph.sources import documents, jsonl
from lexigraph.sources.cache import SnapshotStore, load, needs_refresh
from lexigraph.streaming import ingest


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_tags(spark):
    codes = ["<i>ch.</i> = h.", "ch. = b. h.", "h. a. ch.", "h. = ch.", "ch. = Syr.", "<i>b. h.</i>", "(ch.)", "Ar.", "h.", "", None, "xyz"]
    assert column(spark, codes, etl.language) == ["ar+he", "ar+bh", "he+ar", "he+ar", "ar", "bh", "ar", "ab", "he", None, None, None]
    texts = ["<i>pr. n. f.</i> x", "m. pl. y", "interj.", "part. x", "conj.", "adj.", "adv.", "f. x", "n.", "v.", "none", None]
    got = column(spark, texts, lambda c: F.concat_ws("/", etl.speech(c, F.lit(False)).ps, etl.speech(c, F.lit(False)).gn))
    assert got == ["n/f", "n/m", "ij", "pt", "cj", "a", "av", "n/f", "n", "v", "", ""]
    assert column(spark, ["m."], lambda c: etl.speech(c, F.lit(True)).ps) == ["v"]


def test_links(spark):
    html = '<a class="refLink" href="/Book,_אב.1" data-ref="B">x</a> <a class="refLink" href="/Gen.1" data-ref="Genesis 1">y</a>'
    assert column(spark, [html], lambda c: etl.rewrite_links(c, "Book", "https://t.example")) == ['<a href="#אב" class="word-link">x</a> <a href="https://t.example/Genesis 1" target="_blank" rel="noopener noreferrer" class="ref-link">y</a>']
    assert column(spark, [html], etl.data_refs) == [["B", "Genesis 1"]]
    nested = '<a href="#rid:X" class="word-link"><a class="refLink" href="/Book,_q">t</a>.</a>'
    assert column(spark, [nested], lambda c: etl.strip_nested_links(c, "Book")) == ['<a href="#rid:X" class="word-link">t.</a>']
    other = '<a class="refLink" href="/Other,_w.1">t</a>'
    assert column(spark, [other, None], lambda c: etl.strip_nested_links(c, "Book")) == [other, None]
    assert column(spark, ['<abbr class="x" title="a > b">y</abbr> <i title="k">', "<abbr title='q'>z</abbr>"], etl.strip_titles) == ['<abbr class="x">y</abbr> <i title="k">', "<abbr>z</abbr>"]
    assert [r[0] for r in spark.createDataFrame([("A", "x y"), ("B", "x y")], "k string, t string").select(etl.patch(F.col("t"), F.col("k"), "A", "x", "z")).collect()] == ["z y", "x y"]


def test_nested_report(spark):
    """Trees as they come: strings at any depth, JSON in a string, escapes, other works, a link without an end, broken text."""
    bad, other = '<a class="refLink" href="/Book,_q">ט</a>', '<a class="refLink" href="/Other,_q">t</a>'
    tree = lambda d: json.dumps({"s": [{"d": "x", "n": None}, {"s": {"d": d}}], "k": 1.50})
    texts = [tree(bad * 2 + other), tree("none"), json.dumps(tree(bad)), json.dumps(json.dumps(tree(bad))), json.dumps({"d": bad}, ensure_ascii=False), None, tree('<a class="refLink" href="/Book,_q">'), '{"d": "/Book,_', json.dumps({"d": bad}).replace("refLink", "ref\\u004cink")]
    rows = [(1 + (i > 1), i, t) for i, t in enumerate(texts)]
    cleaned, report = etl.clean_nested_links(spark.createDataFrame(rows, "part int, i int, c string"), "c", "Book")
    assert {tuple(r) for r in report.collect()} == {(1, 1, 2, 0), (2, 4, 4, 2), (None, 5, 6, 2)}
    got = {r.i: r.c for r in cleaned.collect()}
    assert got == {0: tree("טט" + other), 1: texts[1], 2: json.dumps(tree("ט")), 3: json.dumps(json.dumps(tree("ט"))), 4: '{"d": "ט"}', 5: None, 6: texts[6], 7: texts[7], 8: json.dumps({"d": "ט"})}


def test_abbreviations(spark):
    known = ["Ber.", "Ber. R.", "B.", "s. v."]
    html = "Ber. R. x (Ber.) <a href='q'>Ber.</a> <abbr>Ber.</abbr> <i>Ber.</i>; xBer. B. (s. v.), Ber.:"
    want = "<abbr>Ber. R.</abbr> x (<abbr>Ber.</abbr>) <a href='q'>Ber.</a> <abbr>Ber.</abbr> <i><abbr>Ber.</abbr></i>; xBer. B. (<abbr>s. v.</abbr>), Ber.:"
    assert column(spark, [html, None, "", "<"], lambda c: etl.mark_abbreviations(c, known)) == [want, None, "", "<"]


def test_categories_and_allow_list(spark):
    refs = spark.createDataFrame([(1, "Orvaya Zakit 5"), (1, "Orvaya 2"), (1, "orvaya 2"), (1, "Zzz"), (1, "Zzz"), (2, "Orvayan 3")], "seq int, ref string")
    books = spark.createDataFrame([("Orvaya", "t"), ("Orvaya Zakit", "mi")], "book string, category string")
    assert {(r.seq, r.category, tuple(r.refs)) for r in etl.categorise(refs, books).collect()} == {(1, "mi", ("Orvaya Zakit 5",)), (1, "t", ("Orvaya 2", "orvaya 2")), (1, "o", ("Zzz",)), (2, "o", ("Orvayan 3",))}
    html = spark.createDataFrame([(1, '<a href="javascript:x" onclick=\'y\' class="k">t</a><script>z</script><SPAN dir="rtl" style=q></SPAN>'), (2, "<b>ok</b> 1 < 2"), (3, None)], "id int, t string")
    assert {(r.id, r.rule, r.value, r.n) for r in etl.markup_violations(html, "id", "t").collect()} == {(1, "address", "javascript:x", 1), (1, "attribute", "a.onclick", 1), (1, "tag", "script", 2), (1, "attribute", "span.style", 1)}


def test_keys_fields_targets(spark):
    doc = {"content": {"senses": [{"definition": 'the "senses": x', "grammar": {"verbal_stem": "v"}}]}, "headword": "q", "other": {"page": 1}}
    assert json.loads(column(spark, [json.dumps(doc)], etl.shorten_keys)[0]) == {"c": {"s": [{"d": 'the "senses": x', "g": {"vs": "v"}}]}, "hw": "q", "other": {"p": 1}}
    df = spark.createDataFrame([(1, [], ["a"], "x", "y")], "seq int, pf array<string>, ah array<string>, _id string, q string")
    assert [tuple(r) for r in etl.strip_fields(df).collect()] == [(1, None, ["a"], "y")]
    entries = spark.createDataFrame([(0, "A1", "אב"), (1, "A2", "אב"), (2, None, "גד")], "seq int, id string, hw string")
    links = spark.createDataFrame([("אב",), ("גד",), (None,)], "target string")
    assert {tuple(r) for r in etl.resolve_word_links(links, entries).collect()} == {("אב", "A1"), ("גד", None), (None, None)}


ROWS = [(0, "a", 1), (1, "b", 2), (2, "b", 3), (3, None, 4)]


def test_changes(spark):
    rows = spark.createDataFrame(ROWS, "seq int, id string, v int")
    updates = spark.createDataFrame([(0, "b", 9), (1, "b", 8), (2, "z", 7), (3, None, 6)], "seq int, id string, v int")
    assert sorted(tuple(r) for r in crud.update_rows(rows, updates, order="seq").collect()) == [(0, "a", 1), (1, "b", 8), (1, "b", 8), (3, None, 4)]
    assert sorted(map(tuple, crud.update_report(rows, updates).collect()), key=str) == sorted([("b", 200), ("b", 200), ("z", 404), (None, 404)], key=str)
    new = spark.createDataFrame([(5, "c", 1), (6, "c", 2), (7, "a", 3), (8, "", 4), (9, None, 5)], "seq int, id string, v int")
    after, report = crud.insert_rows(rows, new)
    assert sorted((r.seq for r in after.collect())) == [0, 1, 2, 3, 5]
    assert {tuple(r) for r in report.collect()} == {("c", 201, 1), ("c", 409, 1), ("a", 409, 1), ("", 400, 1), (None, 400, 1)}
    left, report = crud.delete_first(rows, spark.createDataFrame([("b",), ("b",), ("z",)], "id string"))
    assert sorted(r.seq for r in left.collect()) == [0, 2, 3] and {tuple(r) for r in report.collect()} == {("b", 200), ("z", 404)}


def test_classification(spark):
    entries = spark.createDataFrame([(i, f"E{i}", f"w{i}", ("he" if i % 2 else None, "n" if i == 3 else "" if i == 4 else None, None), '{"s":[{"d":"def"}]}' if i else "{") for i in range(45)], "seq long, id string, hw string, g struct<l:string,ps:string,gn:string>, c string")
    notes = spark.createDataFrame([("E5", "needs-review", "AI suggests: ps=n"), ("E6", "needs-review", "other"), ("E7", "ocr", "AI suggests: x"), (None, "needs-review", "AI suggests: y")], "rid string, type string, note string")
    todo = annotate.unannotated(entries, notes)
    assert {r.seq for r in todo.collect()} == set(range(45)) - {3, 5}
    prompts = annotate.batches(annotate.first_definition(todo))
    assert sorted((r.batch, r.n) for r in prompts.collect()) == [(0, 20), (1, 20), (2, 3)]
    first = prompts.where("batch = 0").first().prompt.split("\n")
    assert first[0] == "RID: E0 | Headword: w0 | Language: ? | Definition: " and first[1] == "RID: E1 | Headword: w1 | Language: he | Definition: def"

    def model(prompt):
        if "E44" in prompt:
            raise RuntimeError("down")
        return "Sure: " + json.dumps([{"rid": line.split()[1], "ps": "n", "gn": "null"} for line in prompt.split("\n")]) if "E0 " in prompt else "no json"

    answers = annotate.classify(prompts, model)
    assert sorted(r.answer is None for r in answers.collect()) == [False, False, True]
    made = annotate.suggestions(answers, "2024-01-02").collect()
    assert len(made) == 20 and {(r.type, r.note) for r in made} == {("needs-review", "AI suggests: ps=n")}
    assert {r.note for r in annotate.drop_notes(notes, "other").collect()} == {"AI suggests: ps=n", "AI suggests: x", "AI suggests: y"}


def shown(tree, level=0, info="", path=""):
    """(kind, level, path, info) in the order shown, walked over a parsed list of senses."""
    out, rows = [], [(i, s) for i, s in enumerate(tree if isinstance(tree, list) else [tree]) if isinstance(s, dict)]
    if not rows:
        return out
    at = lambda i: f"{path}.{i}" if path else str(i)
    named = lambda s, short, long: s[short] if s.get(short) is not None else s.get(long)
    g = lambda s: isinstance(named(s, "g", "grammar"), (dict, list)) or bool(named(s, "g", "grammar"))
    d, n, below = (lambda s: named(s, "d", "definition")), (lambda s: named(s, "n", "number")), (lambda s: named(s, "s", "senses"))
    some = lambda x: isinstance(x, dict) or isinstance(x, list) and any(isinstance(y, dict) for y in x)

    def section(i, s, deep, line=""):
        inner = shown(below(s), deep + 1, line, at(i)) if some(below(s)) else []
        return [("grammar", deep, at(i), ""), *inner]

    first, lead = rows[0]
    if d(lead) and not n(lead) and not g(lead) and len(rows) > 1:
        out.append(("primary", level, at(first), info))
        for i, s in rows[1:]:
            if d(s) and n(s):
                out += section(i, s, level + 1) if g(s) else [("numbered", level + 1, at(i), "")]
        for i, s in rows[1:]:
            if g(s):
                out += section(i, s, level)
        return out
    if info and n(lead):
        out.append(("language", level, at(first), info))
        info = ""
    for i, s in rows:
        if g(s):
            out += section(i, s, level, info)
            info = "" if some(below(s)) else info
        elif d(s):
            out.append(("numbered" if n(s) else "plain", level, at(i), info))
            info = ""
    return out


def test_senses_as_shown(spark):
    forms = {"vs": "Pi.", "bf": ["x", "y"]}
    trees = [
        [{"d": "a"}, {"d": "b", "n": "— 1) "}, {"g": forms, "s": [{"d": "c"}, {"d": "d", "n": "2)"}]}, {"d": "dropped"}, {"d": "e", "n": "3) "}],
        [{"d": "a", "n": "1)", "s": [{"d": "hidden"}]}, {"g": forms, "s": [{"g": {"bf": "z"}, "s": [{"d": "deep"}, None]}]}, {"n": "only"}],
        [{"d": "single"}], [], [{"n": "x"}], [{"g": {"vs": "Nif."}}, {"d": "p"}], [{"g": forms, "s": [{"d": "child"}]}, {"d": "x"}], [{"g": {}}, {"d": "p"}], [{"d": "a"}, {"d": "b", "n": "1", "g": forms, "s": [{"d": "twice"}]}, {"g": {}}],
        [{"g": {}, "s": []}, {"g": {}, "s": [{"x": 1}]}, {"d": "lost"}], {"d": "alone", "s": {"d": "no"}}, [None, {"g": {"bf": []}, "s": {"g": False, "d": "q", "n": "1"}}], [{"g": "x"}, {"g": 0, "d": "y"}, {"g": "", "d": "z"}],
    ]
    rows = [(i, "h." if i % 3 else "", json.dumps({"s": t})) for i, t in enumerate(trees)] + [(90, "h.", None), (91, "h.", "{"), (92, "h.", json.dumps(json.dumps({"s": trees[6]}))), (93, None, json.dumps({"s": trees[6]}))]
    rows += [(100 + i, "h.", json.dumps({"s": t})) for i, t in enumerate(trees)]
    df = spark.createDataFrame(rows, "seq long, li string, c string")
    got = {}
    for r in senses.shown_senses(df).orderBy("seq", "place").collect():
        got.setdefault(r.seq, []).append((r.kind, r.level, r.path, r.info or ""))
    want = {i: shown(t, 0, "h." if i % 3 else "") for i, t in enumerate(trees)} | {92: shown(trees[6], 0, "h."), 93: shown(trees[6])} | {100 + i: shown(t, 0, "h.") for i, t in enumerate(trees)}
    assert got == {i: x for i, x in want.items() if x}
    assert got[106] == [("grammar", 0, "0", ""), ("plain", 1, "0.0", "h."), ("plain", 0, "1", "")] and got[107][1] == ("plain", 0, "1", "h.")
    assert [x[2] for x in got[108]] == ["0", "1", "1.0", "1", "1.0", "2"] and got[101][0] == ("language", 0, "0", "h.")
    r = senses.shown_senses(df).where("seq = 0 and kind = 'grammar'").first()
    assert (r.stem, r.forms, r.text, r.number) == ("Pi.", "x, y", None, None)
    assert senses.shown_senses(df).where("seq = 0 and path = '1'").first().number == "1)"
    assert senses.shown_senses(df).where("seq = 1 and path = '1.0'").first().forms == "z"
    messages = {r.seq: r.message for r in senses.contents(df.where("seq < 100")).collect()}
    assert messages == {i: "No content available" if not t else None if shown(t) else "No definition available" for i, t in enumerate(trees)} | {90: "No content available", 91: "No content available", 92: None, 93: None}
    assert senses.shown_senses(df.limit(0)).count() == 0 and senses.contents(df.limit(0)).count() == 0


def test_senses_of_the_data_as_shown(spark, duck):
    from conftest import DATA

    entries = spark.read.parquet(f"{DATA}/entries.parquet")
    got = {}
    for r in senses.shown_senses(entries).orderBy("seq", "place").collect():
        got.setdefault(r.seq, []).append((r.kind, r.level, r.path, r.info or ""))
    want = {}
    for r in entries.select("seq", "li", "c").collect():
        try:
            tree = json.loads(r.c)
            tree = json.loads(tree) if isinstance(tree, str) else tree
        except (TypeError, ValueError):
            continue
        top = tree.get("s") or tree.get("senses") if isinstance(tree, dict) else tree
        if x := shown(top or [], 0, r.li or ""):
            want[r.seq] = x
    assert got == want and len(got) > 100


def test_references_and_badges(spark):
    df = spark.createDataFrame([(1, {"o": ["q"], "t": [f"t{i}" for i in range(10)] + [None], "j": ["no"]}, ("he", "zz", "m")), (2, None, None)], "seq int, rf map<string,array<string>>, g struct<l:string,ps:string,gn:string>")
    got = [(r.place, r.category, r.ref, r.visible) for r in senses.shown_references(df).orderBy("place").collect()]
    assert got[0] == (0, "t", "t0", True) and got[-1] == (10, "o", "q", False) and len(got) == 11
    assert [tuple(r) for r in senses.badges(df).collect()] == [(1, 0, "Heb.", "Hebrew"), (1, 2, "m", "Masculine")]


def test_json_lines(spark, tmp_path):
    one = [json.dumps({"id": f"A{i}", "p": i if i % 2 else str(i), "c": {"s": [{"d": "x"}]}, "rf": {"t": ["r"]}}) for i in range(50)]
    (tmp_path / "b1.jsonl").write_text("\n".join([*one[:20], "", "{broken", "  ", *one[20:]]))
    (tmp_path / "a2.jsonl").write_text(json.dumps({"id": "Z"}) + "\n[1]\n")
    rows, bad = jsonl.read_lines(spark, [str(tmp_path / "b1.jsonl"), str(tmp_path / "a2.jsonl")])
    got = rows.orderBy("seq").collect()
    assert [(r.seq, r.part, r.id) for r in got] == [(i, 1, f"A{i}") for i in range(50)] + [(50, 2, "Z")]
    assert got[3].p == "3" and json.loads(got[3].c) == {"s": [{"d": "x"}]} and got[3].rf == {"t": ["r"]}
    assert {r.line for r in bad.collect()} == {"{broken", "[1]"}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        assert [r.id for r in jsonl.read_lines(spark, str(tmp_path / "b1.jsonl"))[0].orderBy("seq").collect()] == [f"A{i}" for i in range(50)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    with pytest.raises((PySparkException, Py4JJavaError)):
        jsonl.read_lines(spark, str(tmp_path / "b1.jsonl"), mode="fail")[0].collect()
    jsonl.write_lines(jsonl.split_at(rows, 20), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 51 and back.where("part = 1").count() == 20


def test_documents(spark, tmp_path):
    write = lambda name, doc: (tmp_path / name).write_text(doc if isinstance(doc, str) else json.dumps(doc)) and str(tmp_path / name)
    assert {tuple(r) for r in documents.read_abbreviations(spark, write("a.json", {"abbreviations": {"B.": {"original": "x", "modern": "y"}}})).collect()} == {("B.", "x", "y")}
    with pytest.raises(PySparkException):
        documents.read_abbreviations(spark, write("b.json", {"other": 1})).collect()
    assert [tuple(r) for r in documents.read_abbreviation_lines(spark, write("c.json", {"versions": [{"text": ["h", "h", "x", "y"]}, {"text": ["q"] * 5}]})).collect()] == [(2, "x"), (3, "y")]
    sages, landmarks = documents.read_graph(spark, write("d.json", {"sages": [{"id": "a"}, {"id": "b"}], "landmarks": [{"year": 70, "label": "z"}]}), "struct<id:string,era:string>")
    assert [tuple(r) for r in sages.collect()] == [(0, "a", None), (1, "b", None)] and [tuple(r) for r in landmarks.collect()] == [(70, "z")]
    assert {tuple(r) for r in documents.read_lookup(spark, write("e.json", {"g": {"k": "v"}})).collect()} == {("g", "k", "v")}
    assert documents.read_annotations(spark, write("f.json", {"A": [{"type": "t", "note": "n", "created": "2024-01-02"}]})).count() == 1
    assert documents.read_annotations(spark, str(tmp_path / "missing.json")).count() == 0 and documents.read_annotations(spark, write("g.json", "{bad")).count() == 0
    documents.write_document(sages.orderBy("pos"), str(tmp_path / "out"), "sages")
    assert json.loads("\n".join(r.value for r in spark.read.text(str(tmp_path / "out")).collect()))["sages"][1]["id"] == "b"


def test_snapshots(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    assert store.read("t") is None and store.marker("t") is None
    store.write("t", spark.range(3), "v1")
    store.write("t", spark.range(5), "v2")
    assert store.marker("t")["version"] == "v2" and store.read("t").count() == 5
    assert needs_refresh(None, None) and needs_refresh("a", "b") and not needs_refresh("a", "a") and not needs_refresh("a", None)
    calls = []
    fetch = lambda: calls.append(1) or spark.range(7)
    assert load(store, "t", lambda: "v2", fetch).count() == 5 and not calls
    assert load(store, "t", lambda: 1 / 0, fetch).count() == 5 and not calls
    assert load(store, "t", lambda: "v3", fetch).count() == 7 and store.marker("t")["version"] == "v3"
    assert load(store, "new", lambda: 1 / 0, fetch).count() == 7 and store.marker("new")["version"] == "unknown"
    store.clear("t", spark.range(1))
    assert store.read("t").count() == 0


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(3):
        (folder / f"p{part}.jsonl").write_text("\n".join([json.dumps({"id": f"A{part}{i}", "hw": "אָב", "rf": {"t": [f"X. {i}"]}}) for i in range(5)] + ["{bad", ""]))
    told = []
    spark.streams.addListener(listener := ingest.Progress(lambda rows, speed: told.append(rows)))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # a second run finds nothing new
        ingest.ingest(ingest.read_stream(spark, str(folder)), out, checkpoint).awaitTermination(120)
    spark.streams.removeListener(listener)
    assert spark.read.parquet(out + "/entries").count() == 15
    assert {r.norm for r in spark.read.parquet(out + "/entries").collect()} == {"אב"}
    assert {r.norm for r in spark.read.parquet(out + "/entry_refs").collect()} == {f"x {i}" for i in range(5)}


def test_debounce(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'u', timestamp'2024-01-01 00:00:00.000'), (2, 'u', timestamp'2024-01-01 00:00:00.100'), (3, 'u', timestamp'2024-01-01 00:00:00.250'), (4, 'v', timestamp'2024-01-01 00:00:00.100') AS t(event_id, k, ts)")
    assert {r.event_id for r in annotate.edges_of_bursts(df, "k", "ts").collect()} == {2, 3, 4}


def test_version_check_gives_up(spark, tmp_path):
    """A version that fails or does not come in time leaves the cached table in use."""
    import time

    def broken():
        raise OSError

    store = SnapshotStore(spark, str(tmp_path))
    assert load(store, "t", lambda: "v1", lambda: spark.range(3)).count() == 3
    began = time.monotonic()
    assert load(store, "t", lambda: time.sleep(60) or "v2", lambda: spark.range(9), seconds=0.2).count() == 3
    assert load(store, "t", broken, lambda: spark.range(9)).count() == 3
    assert time.monotonic() - began < 30
    assert load(store, "t", lambda: "v2", lambda: spark.range(9)).count() == 9
