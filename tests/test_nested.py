"""Structural indexing against a walk over parsed JSON."""

import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexigraph.operators.nested import _flatten, flatten_senses, sense_texts


def named(x, short, long):
    """The value of a key by either name: the short one unless it is null."""
    return x[short] if x.get(short) is not None else x.get(long)


def walked(text):
    """(kind, path, parent) of a JSON text, or None if there is no complete document."""
    try:
        doc = json.loads(text)
        while isinstance(doc, str):
            doc = json.loads(doc)
    except (TypeError, ValueError):
        return None
    out = set()

    def senses(v, above):
        for i, x in enumerate(v if isinstance(v, list) else [v]):
            if not isinstance(x, dict):
                continue
            path = f"{above}.{i}" if above else str(i)
            out.add(("sense", path, above))
            if isinstance(below := named(x, "s", "senses"), (list, dict)):
                senses(below, path)
            if isinstance(g := named(x, "g", "grammar"), dict):
                f = named(g, "bf", "binyan_form")
                for j, form in enumerate(f if isinstance(f, list) else [f]):
                    if isinstance(form, str):
                        out.add(("form", f"{path}:{j}", path))

    while isinstance(doc, dict):
        if isinstance(found := named(doc, "s", "senses"), (list, dict)):
            senses(found, "")
            break
        doc = named(doc, "c", "content")
    else:
        if isinstance(doc, list):
            senses(doc, "")
    return out


def indexed(texts):
    out = [set() for _ in texts]
    bad = set()
    for found in _flatten(pa.array(texts, pa.string()), False):
        for row, kind, path, parent in zip(list(found["row"]), found["kind"], found["path"], found["parent"]):
            if kind == "unreadable":
                bad.add(row)
            else:
                out[row].add((kind, path, parent))
    return [None if i in bad else x for i, x in enumerate(out)]


CASES = [
    None, "", "  ", "null", "{}", "[]", "3", "true", '"x"', '"{}"', '{"s":[]}', '{"s":{"d":"a"}}', '[{"d":"a"},null,{"d":"b"}]', '{"s":[null,{"d":"x","s":[null,{"d":"y"}]}]}',
    '{"s":[{"g":{"vs":"Pi.","bf":["a","b"]}},{"g":{"bf":"c"}},{"g":{"bf":null}},{"g":null}]}', '{"senses":[{"definition":"a","grammar":{"binyan_form":["x",null,"y"]},"senses":{"number":"1"}}]}',
    '{"s":[{"d":"a \\"quoted\\" {[,:]} \\\\"}]}', '{"s":[{"d":"\\u05d0"}]}', '{"s":[{"d":"\\u05"}]}', '{"s":[{"d":"a"}', '{"s":[{"d":"a"}]}}', '{"s":[{"d":"a"]}', '{"s" [1]}', '{"s":[1,]}', '{"s":[{"d":1 2}]}',
    '{"s":[{,}]}', '{"s":}', '{:1}', '{"s":[{"d":tru}]}', '{"s":[{"d":01}]}', '{"s":[{"d":-1.5e3}]} ', '{"s":["text",3,{"d":"x"}]}', '[[{"d":"x"}]]', '{"s":[{"x":{"s":[{"d":"no"}]}}]}', '{"s":[{"d":"a"}]} {"s":[]}',
    json.dumps(json.dumps({"s": [{"d": 'q"\\', "g": {"bf": ["f"]}}]})), '"{\\"s\\":[{\\"d\\"', "\\", '"\\', '{"s":[{"d":"a"}]}\n', "[" * 300 + "]" * 300, '{"s":' * 50 + "[{}]" + "}" * 50,
]


def test_cases_together_and_alone():
    want = [walked(t) for t in CASES]
    assert indexed(CASES) == want
    assert [indexed([t])[0] for t in CASES] == want


leaf = st.none() | st.booleans() | st.integers(-5, 5) | st.text(alphabet='ab"\\{}[],:\n א', max_size=6)
keys = st.sampled_from(["s", "senses", "d", "g", "bf", "grammar", "binyan_form", "n", "c", "content", "x"])
docs = st.recursive(leaf, lambda x: st.lists(x, max_size=4) | st.dictionaries(keys, x, max_size=4), max_leaves=25)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(docs, st.integers(0, 12), st.booleans()), min_size=1, max_size=8))
def test_any_documents(items):
    texts = []
    for doc, cut, ascii_ in items:
        text = json.dumps(doc, ensure_ascii=ascii_)
        texts.append(text[: len(text) - cut] if cut > 9 else text)
    got = indexed(texts)
    for text, x in zip(texts, got):
        assert x == walked(text), text


ODD = [
    '{"\\u0073":[{"\\u0064":"a","g":{"b\\u0066":["x"]}}]}', '{"c":{"c":{"c":{"content":{"c":{"s":[{"d":"deep"}]}}}}}}', '{"c":{"c":[{"d":"a"},{"s":{}}]}}', '{"s":null,"senses":[{}]}', '{"senses":[{},{}],"s":[{}]}',
    '{"s":[{}],"s":[{},{}]}', '{"s":[{}],"s":null}', '{"s":[{"g":{"bf":"a","bf":["b","c"]}}]}', '{"s":[{"d":"a\nb"}]}', '{"s":[{"d":"a\tb"}]}', '{"s":\n\t[{}]}', '{"s":[{"d":"\x01"}]}', '{"s":[{"d":"\\ud800"}]}', '{"c":{"s":[{}]},"s":[{},{}]}',
    '{"s":[{"n":12345678901,"m":1.5E+10,"k":nulll}]}', '{"s":[{"n":12345678901,"m":1.5E+10,"k":1234567}]}', '{"s":[{"n":0123456789}]}', json.dumps(json.dumps(json.dumps(json.dumps(json.dumps(json.dumps({"s": [{}]})))))), json.dumps(json.dumps(json.dumps(json.dumps(json.dumps(json.dumps('{"s":')))))),
]


def test_odd_documents():
    """Escaped and repeated names, wrapped contents, control characters, strings in strings in strings."""
    assert indexed(ODD) == [walked(t) for t in ODD]
    assert [indexed([t])[0] for t in ODD] == [walked(t) for t in ODD]
    assert len(indexed(ODD)[1]) == 1 and indexed(ODD)[8] is None


def test_any_depth():
    """Brackets fifty thousand deep, and seventeen thousand senses one below another."""
    brackets = '{"x":' + "[" * 50_000 + "]" * 50_000 + ',"s":[{"d":"a"}]}'
    wrapped = '{"c":' * 50_000 + '{"s":[{}]}' + "}" * 50_000
    assert indexed([brackets, wrapped]) == [{("sense", "0", "")}] * 2
    deep, n = '{"s":[' * 17_000 + "{}" + "]}" * 17_000, 0
    for found in _flatten(pa.array([deep]), False):
        n += len(found["row"])
        assert {*found["kind"]} == {"sense"} and sum(map(len, found["path"])) < 1 << 27
    assert n == 17_000


def test_operator(spark):
    rows = [(1, '{"s":[{"d":"a","n":"1) ","g":{"vs":"Pi.","bf":["f"]}}]}', "k"), (2, None, "k"), (2, None, "k"), (3, "", None), (4, '{"s":[', "z")]
    df = spark.createDataFrame(rows, "seq long, c string, path string")
    got = {tuple(r) for r in flatten_senses(df, "c", "seq", text=True).collect()}
    assert got == {(1, "sense", "0", "", 0, "a", "1) ", "Pi.", None), (1, "form", "0:0", "0", 0, None, None, None, "f"), (2, "unreadable", "null", "", 0, None, None, None, None), (3, "unreadable", "empty", "", 0, None, None, None, None), (4, "unreadable", "broken", "", 0, None, None, None, None)}
    clash = flatten_senses(df, "c", "seq", "path", prefix="x_")
    assert clash.columns == ["seq", "path", "x_kind", "x_path", "x_parent", "x_pos"] and clash.count() == 6
    assert flatten_senses(df, "c", "seq", "path").columns == ["seq", "path", "sense_kind", "sense_path", "sense_parent", "sense_pos"]
    assert sense_texts(df, "c", "seq", "path", containing="a", out="path").columns == ["seq", "path"]
    assert flatten_senses(df.limit(0), "c", "seq").count() == 0


def test_very_long_document(spark):
    text = json.dumps({"s": [{"d": "x" * 3_000_000, "s": [{"d": "y"}] * 1000}]})
    df = spark.createDataFrame([(1, text), (2, '{"s":[{}]}')], "seq long, c string")
    assert flatten_senses(df, "c", "seq").count() == 1002


def test_texts(spark):
    rows = [
        (1, '{"s":[{"d":"see <A HREF=x>"},{"d":"none"},{"n":"href"}]}'), (2, '"{\\"s\\":[{\\"d\\":\\"href\\"}]}"'), (3, "{"), (4, None), (5, '{"s":[{"d":"<a \\u0068ref=x>"}]}'), (6, '{"s":[{"\\u0064":"h\\u0052ef"}]}'),
        (7, '{"c":{"c":{"c":{"c":{"s":{"d":"href","d":"b href"}}}}}}'), (8, json.dumps(json.dumps(json.dumps(json.dumps(json.dumps(json.dumps('{"s":{"d":"href"}}'))))))), (9, '{"s":[{"d":"\\u05d0 h ref"}]}'),
    ]
    df = spark.createDataFrame(rows, "seq long, c string")
    for needle in ("href", "h", "HREF=X", "\u05d0"):
        got = {(r.seq, tuple(r.texts)) for r in sense_texts(df, "c", "seq", containing=needle).collect()}
        every = flatten_senses(df, "c", "seq", text=True).where("kind = 'sense'").select("seq", "path", "d").collect()
        want = {}
        for r in sorted(every):
            if r.d and needle.lower() in r.d.lower():
                want.setdefault(r.seq, []).append(r.d)
        assert got == {(k, tuple(v)) for k, v in want.items()}, needle
        assert needle != "href" or {k for k, _ in got} == {1, 2, 5, 6, 7, 8}


def test_texts_of_the_data(spark, duck):
    from conftest import DATA

    df = spark.read.parquet(f"{DATA}/entries.parquet")
    for needle in ("href", "ref-link", "word-link"):
        got = sense_texts(df, "c", "seq", containing=needle).selectExpr("seq", "explode(texts) d").collect()
        want = flatten_senses(df, "c", "seq", text=True).where(f"contains(lower(d), '{needle}')").select("seq", "d").collect()
        assert want and sorted(got) == sorted(want)


@pytest.mark.parametrize("chunk", [1, 50, 10_000])
def test_chunks_do_not_matter(monkeypatch, chunk):
    from lexigraph.operators import nested

    monkeypatch.setattr(nested, "CHUNK", chunk)
    monkeypatch.setattr(nested.chunks, "__defaults__", (chunk,))
    assert indexed(CASES) == [walked(t) for t in CASES]
