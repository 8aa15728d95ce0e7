"""Encoding against two public libraries, on odd texts and on the test documents."""

import base64
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA

from lexigraph.llm.encode import Encoded, PerfectHash, count_tokens, default_vocabulary, encode, vocabulary

pytestmark = pytest.mark.skipif(not os.path.exists(default_vocabulary()), reason="no tokenizer files")

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TEXTS = [
    "", " ", "\n", "   ", "  a  b\n\n c \n", "'s", "it's we'll I'd they've you're I'm don't", "'stuff ''s 's", "x 's", "'rex", "'", "a'", "'d'm's", "'S", "!'s", "<|endoftext|>", "a　b", "  x", "\x1c\x1da", "\u0085x", "²³½Ⅷ٣٤", "😀're 👨‍👩‍👧", "אָבּ גד׃", "x" * 5000, "אבגד" * 700,
    "!'" * 300, "\t\r\n\r\n ", "a﻿b", "éé", "\U0010ffff", "١٢ab12", "…—", "​‎", "ſ's",
]


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    with open(default_vocabulary(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    x = Encoded(pa.array(texts, pa.string()), vocabulary(default_vocabulary()))
    at = np.append(0, np.cumsum(x.doc_tokens))
    return [x.ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_every_code_point_has_its_class():
    import regex

    table = vocabulary(default_vocabulary()).classes
    for code in [*range(0x31F00, 0x32500), 0x20000, 0x2FA1D, 0xE0100, 0x10FFFD, 0x1D7CE, 0x661, 0x41, 0x5D0, 0x20]:
        c = chr(code)
        assert table[code] == (0 if regex.match(r"\p{L}", c) else 1 if regex.match(r"\p{N}", c) else 3 if c == " " else 2), hex(code)
    assert table[0x32000] == 0 == table[0x323AF]


def test_odd_texts(reference):
    assert encoded(TEXTS) == [reference.encode_ordinary(t) for t in TEXTS]
    assert [encoded([t])[0] for t in TEXTS] == [reference.encode_ordinary(t) for t in TEXTS]
    assert encoded([None, "a", None]) == [[], reference.encode_ordinary("a"), []] and encoded([]) == []


def test_random_texts(reference):
    rng = random.Random(7)
    signs = list("a's tlrevdm \n\t1!éאָ　 'Z״_") + ["😀", "’", "́", "١"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    assert encoded(texts) == [reference.encode_ordinary(t) for t in texts]


def test_second_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(default_vocabulary().replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    assert encoded(TEXTS) == [x.ids for x in t.encode_batch(TEXTS, add_special_tokens=False)]


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 20_000).astype(np.uint64))
    h = PerfectHash(keys)
    assert sorted(h.find(keys).tolist()) == list(range(len(keys))) and h.size == len(keys)
    assert PerfectHash(keys[:0]).find(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        PerfectHash(np.array([5, 5], np.uint64))


def test_operator(spark, reference):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None, TEXTS[6], TEXTS[6]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = {r.doc_id: list(r.tokens) for r in encode(df, "text", "doc_id", out="tokens").collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t, _ in rows}
    assert {r.doc_id: r.n for r in count_tokens(df, "text", "doc_id", "ids", out="n").collect()} == {i: len(x) for i, x in got.items()}
    assert encode(df.limit(0), "text", "doc_id").count() == 0
    assert dict(encode(df, "text", "doc_id", "ids").dtypes) == {"doc_id": "bigint", "ids": "array<int>"}


def test_documents(spark, duck, reference):
    from lexigraph.llm.queries import p6_ids

    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    got = p6_ids(spark, DATA).collect()
    assert len(got) == len(texts) and all(list(r.ids) == reference.encode_ordinary(texts[r.doc_id] or "") for r in got)


def test_broken_bytes():
    good, broken = "abé".encode(), b"a\xff\xfeb"
    off = np.array([0, len(good), len(good) + len(broken)], np.int32)
    texts = pa.Array.from_buffers(pa.string(), 2, [None, pa.py_buffer(off), pa.py_buffer(good + broken)])
    x = Encoded(texts, vocabulary(default_vocabulary()))
    assert x.doc_tokens.tolist() == [len(encoded(["abé"])[0]), len(encoded(["a��b"])[0])]
