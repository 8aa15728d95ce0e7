"""Oversized texts cut into pieces under a token limit, at natural boundaries, with an overlap.

Each token of a text becomes one letter of a boundary string: how strong the boundary after it is (``p`` paragraph, ``s``
sentence or line, ``w`` word, ``c`` between characters only, ``x`` within a character). A regular expression with bounded
quantifiers, whose alternatives are ordered by boundary strength, then takes the string apart; an SQL aggregate over the
parts looks back for the overlap, and byte offsets turn tokens into text. Everything happens within the row: no shuffle.
The time is linear in the length of a text: the aggregate carries the letters that the overlap may reach, not the string,
its results are gathered in blocks, and a text is cut before its pieces become rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import BLANK, Encoded, Vocabulary, _run, count_tokens

#: Signs that end a sentence, and signs that may follow them.
ENDERS, CLOSERS = ".!?…׃؟。！？", "\"'”’)]»״׳"

#: Pieces of a text that are gathered at a time.
BLOCK = 256


def boundaries(x: Encoded, ends: np.ndarray) -> np.ndarray:
    """The letter of the boundary after each token, by the byte ``ends`` of the tokens."""
    n = len(x.point)
    at = np.searchsorted(x.lead, ends)
    whole = (at == n) | (x.lead[np.minimum(at, max(n - 1, 0))] == ends) if n else np.zeros(0, bool)
    out = np.where(whole, ord("c"), ord("x")).astype(np.uint8)
    if not n:
        return out
    blank = np.append(x.kind == BLANK, False)
    line = np.isin(x.point, [10, 11, 12, 0x85, 0x2028]) | ((x.point == 13) & (np.append(x.point[1:], 0) != 10))
    lines = np.append(0, np.cumsum(line + 2 * (x.point == 0x2029)))
    here = np.arange(n + 1)
    run = np.maximum.accumulate(np.where(x.doc_start | np.append(True, ~blank[:-1]), here, 0))  # begin of the white space before
    end, close = np.isin(x.point, [ord(c) for c in ENDERS]), np.isin(x.point, [ord(c) for c in CLOSERS])
    for _ in range(2):
        end[1:] |= close[1:] & end[:-1]
    before = np.append(False, blank[:-1])
    breaks = lines[here] - lines[run]
    sentence = (np.append(False, end) & blank) | (breaks >= 1)
    grade = np.where(x.doc_start | (before & (breaks >= 2)), ord("p"), np.where(before & (breaks >= 1) | sentence & ~before, ord("s"), np.where(before | blank, ord("w"), 0)))[at]
    hit = whole & (grade > 0)
    out[hit] = grade[hit]
    # An apostrophe must not begin a piece that was cut within a run of signs: it could be read as a contraction.
    tick = (out == ord("c")) & (np.append(x.point, 0)[at] == 39) & ~np.append(x.start, False)[at]
    out[tick] = ord("x")
    return out


def cutting_pattern(limit: int, overlap: int) -> str:
    """The regular expression that takes a boundary string apart: the first part may fill the limit, later ones what the
    overlap leaves. A boundary of each strength is looked for in the further half first."""

    def part(n: int) -> str:
        half = n // 2
        graded = "|".join(f".{{{half},{n - 1}}}{c}" for c in "psw")
        return f"(?:.{{1,{n}}}$|{graded}|.{{0,{n - 1}}}[psw]|.{{0,{n - 1}}}[^x]|.{{1,{n}}})"

    return f"^{part(limit)}|{part(limit - overlap)}"


def split_texts(df: DataFrame, text_col: str, *keep: str, limit: int = 512, overlap: int = 64, path: str | None = None, recount: bool = True) -> DataFrame:
    """The pieces of every text: ``keep``, ``piece_no`` (from 0), ``overlap`` (tokens of the text repeated from the piece
    before), ``n_pieces``, ``text`` and ``n_tokens`` (at most ``limit``): those of the piece encoded by itself, or without
    ``recount`` those it has in the text, which are one more where a piece ends in several line ends.

    A piece ends at the strongest boundary of the further half of its room, else at any word end, else between characters.
    It begins ``overlap`` tokens before that end of the piece before, or at the first word begin after that point, if one
    lies before the end. Joined without their overlaps, the pieces of a text are the text.

    Defined cases: null and empty texts have no piece; texts within the limit are one piece; repeated rows are cut alike; a
    text without any boundary is cut between characters; columns of ``keep`` with names of those added are replaced; only within a character of more tokens than fit would bytes be cut.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    keep = tuple(k for k in keep if k not in ("piece_no", "overlap", "n_pieces", "text", "n_tokens"))
    added = [pa.field("__text", pa.string()), pa.field("__n", pa.int64()), pa.field("__marks", pa.string()), pa.field("__ends", pa.list_(pa.int32()))]

    def make(x: Encoded, voc: Vocabulary) -> list[pa.Array]:
        n = x.doc_tokens
        long = n > limit
        token = np.repeat(long, n)
        ends = x.ends(voc)
        marks = boundaries(x, ends)[token]
        ends = (ends - np.repeat(x.offsets[:-1], n))[token].astype(np.int32)
        off = pa.array(np.append(0, np.cumsum(np.where(long, n, 0))).astype(np.int32))
        texts = pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(np.ascontiguousarray(x.offsets)), pa.py_buffer(x.data)]).cast(pa.string())
        strings = pa.Array.from_buffers(pa.string(), len(n), [None, off.buffers()[1], pa.py_buffer(marks)])
        return [texts, pa.array(n), strings, pa.ListArray.from_arrays(off, pa.array(ends))]

    coded = _run(df, text_col, keep, added, "`__text` string, `__n` bigint, `__marks` string, `__ends` array<int>", path, make)
    parts = F.when(F.col("__n") > limit, F.regexp_extract_all("__marks", F.lit(cutting_pattern(limit, overlap)), F.lit(0)))
    # Of the state: s and e, begin and end of the piece before; tail, the letters up to e that an overlap may reach.
    step = f"""(a, i) ->
        transform(array(greatest(a.e - {overlap}, a.s)), lo ->
            transform(array(left(right(a.tail, a.e - lo + 1), a.e - lo)), back ->
                transform(array(case when lo = 0 then 0 when regexp_instr(back, '[psw]') > 0 then lo + regexp_instr(back, '[psw]') - 1 when regexp_instr(back, '[^x]') > 0 then lo + regexp_instr(back, '[^x]') - 1 else a.e end), s ->
                    named_struct('all', concat(a.all, array(named_struct('s', s, 'c', a.e, 'e', a.e + length(element_at(__parts, i))))), 's', s, 'e', a.e + length(element_at(__parts, i)), 'tail', right(concat(a.tail, element_at(__parts, i)), {overlap + 1})))[0])[0])[0]"""
    spans = F.expr(f"""
        flatten(aggregate(sequence(0, (size(__parts) - 1) div {BLOCK}), named_struct('all', cast(array() as array<array<struct<s:int,c:int,e:int>>>), 's', 0, 'e', 0, 'tail', ''), (o, b) ->
            transform(array(aggregate(sequence(int(b * {BLOCK} + 1), int(least((b + 1) * {BLOCK}, size(__parts)))), named_struct('all', cast(array() as array<struct<s:int,c:int,e:int>>), 's', o.s, 'e', o.e, 'tail', o.tail), {step})), r ->
                named_struct('all', concat(o.all, array(r.all)), 's', r.s, 'e', r.e, 'tail', r.tail))[0],
            o -> o.all))""")
    cut = coded.where("__n > 0").withColumn("__parts", parts).withColumn("__spans", F.when(F.col("__n") > limit, spans))
    byte = lambda i: F.when(i == 0, 0).otherwise(F.element_at("__ends", F.greatest(i, F.lit(1))))
    piece = lambda raw: lambda x: F.struct((x.c - x.s).alias("overlap"), F.substring(raw, byte(x.s) + 1, byte(x.e) - byte(x.s)).cast("string").alias("text"), (x.e - x.s).alias("n"))
    many = F.get(F.transform(F.array(F.col("__text").cast("binary")), lambda raw: F.transform("__spans", piece(raw))), F.lit(0))
    whole = F.array(F.struct(F.lit(0).alias("overlap"), F.col("__text").alias("text"), F.col("__n").cast("int").alias("n")))
    held = cut.select(*keep, F.coalesce(F.size("__spans"), F.lit(1)).alias("__pieces"), F.when(F.col("__n") > limit, many).otherwise(whole).alias("__held"))
    # An outer explode, as the optimiser would compute the pieces once more to filter empty ones out of a plain one.
    one = held.select(*keep, "__pieces", F.posexplode_outer("__held").alias("piece_no", "__x"))
    pieces = one.select(*keep, "piece_no", F.col("__x.overlap").cast("bigint").alias("overlap"), F.when(F.col("__pieces") > 0, F.col("__pieces")).otherwise(1).alias("n_pieces"), F.col("__x.text").alias("text"), F.col("__x.n").cast("bigint").alias("n_tokens"))
    if not recount:
        return pieces
    again = pieces.drop("n_tokens").withColumn("__piece", F.col("text"))
    return count_tokens(again, "__piece", *keep, "piece_no", "overlap", "n_pieces", "text", path=path)
