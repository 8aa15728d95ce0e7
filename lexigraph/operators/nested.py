"""Nested JSON documents to linked flat rows by vectorised structural indexing.

The JSON texts of an Arrow batch are one byte buffer. Bitmaps of quotes, brackets and delimiters are built over all of it
at once, strings are masked by a running parity of the unescaped quotes, nesting depth is a prefix sum of the brackets, and
a stable sort by depth brings the tokens of every container side by side, so that parents, keys, array positions and the
grammar itself are checked by comparing neighbours. No document is walked one by one and nothing is shuffled: the operator
is one narrow stage whose memory depends on ``CHUNK`` and the longest single document only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: Bytes of JSON text that are indexed at once.
CHUNK = 2_000_000

#: The short and long key names of the pipeline; a long name has the code of its short one and ``LONG``.
LONG = 8
KEYS = {
    "s": 1, "senses": 1 + LONG,
    "g": 2, "grammar": 2 + LONG,
    "bf": 3, "binyan_form": 3 + LONG,
    "d": 4, "definition": 4 + LONG,
    "n": 5, "number": 5 + LONG,
    "vs": 6, "verbal_stem": 6 + LONG,
    "c": 7, "content": 7 + LONG,
}
SENSES, GRAMMAR, FORMS, TEXT, NUMBER, STEM, CONTENT = range(1, 8)

_OPEN_OBJ, _CLOSE_OBJ, _OPEN_ARR, _CLOSE_ARR, _COLON, _COMMA, _QUOTE, _LIT = b"{}[]:,\"v"
_NUMBER = re.compile(rb"-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?\Z")
_SURROGATE = re.compile("[\ud800-\udfff]")
_STRUCT = np.zeros(256, bool)
_STRUCT[list(b"{}[]:,")] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n")] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_ESCAPES = np.zeros(256, bool)
_ESCAPES[list(b'"\\/bfnrtu')] = True


class Index:
    """Structural index of a chunk of JSON texts. Arrays over its values (objects, arrays, strings, literals), in file order:
    ``row``, ``kind`` (first byte, literals ``v``), ``start``, ``end``, ``parent`` (index of the enclosing value or -1),
    ``key`` (short code of ``KEYS``, 0: other or none) and ``at`` (position in the enclosing array). ``ok`` marks the rows that
    hold one complete JSON document. No two values of an object have the same code: see ``_settle``."""

    def __init__(self, texts: pa.Array):
        n = len(texts)
        sep = pc.binary_join_element_wise(texts.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
        off = np.frombuffer(sep.buffers()[1], np.int64)[sep.offset : sep.offset + n + 1]
        buf = np.frombuffer(sep.buffers()[2], np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
        off = off - off[0]
        self.buf, self.ok = buf, np.ones(n, bool)
        row_of = np.repeat(np.arange(n, dtype=np.int32), np.diff(off))

        # Quotes that no odd run of backslashes precedes; rows with an unpaired one hold no complete document.
        esc = np.zeros(len(buf) + 1, bool)
        slash = np.flatnonzero(buf == 92)
        if len(slash):
            first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
            length = np.diff(first, append=len(slash))
            esc[(slash[first] + length)[length % 2 == 1]] = True
        quote = (buf == _QUOTE) & ~esc[:-1]
        self.ok &= np.bincount(row_of[quote], minlength=n) % 2 == 0
        quote &= self.ok[row_of]
        inside = np.bitwise_xor.accumulate(quote.view(np.uint8)).view(bool) if len(buf) else quote
        self.ok[row_of[np.flatnonzero((buf < 32) & inside)]] = False  # control characters must be escaped
        e = np.flatnonzero(esc[:-1] & inside)
        if len(e):
            bad = ~_ESCAPES[buf[e]]
            u = e[buf[e] == 117]
            self.ok[row_of[e[bad]]] = False
            for k in range(1, 5):
                at = np.minimum(u + k, len(buf) - 1)
                self.ok[row_of[u[~_HEX[buf[at]]]]] = False

        # Tokens outside strings: brackets and delimiters, opening quotes, first bytes of literals.
        struct = _STRUCT[buf] & ~inside
        lit = ~(inside | quote | struct | _BLANK[buf])
        begin = lit.copy()
        begin[1:] &= ~lit[:-1]
        pos = np.flatnonzero((struct | (quote & inside) | begin) & self.ok[row_of])
        kind = buf[pos].copy()
        kind[begin[pos]] = _LIT
        row = row_of[pos]

        # Depth as a prefix sum; a row must return to 0 and never fall below it.
        step = ((kind == _OPEN_OBJ) | (kind == _OPEN_ARR)).astype(np.int32) - ((kind == _CLOSE_OBJ) | (kind == _CLOSE_ARR))
        net = np.bincount(row, weights=step, minlength=n)
        self.ok &= net == 0
        keep = self.ok[row]
        pos, kind, row, step = pos[keep], kind[keep], row[keep], step[keep]
        depth = np.cumsum(step)
        self.ok[row[depth < 0]] = False

        # Every opening bracket twice: as an element of its container and as the marker of its own; stable sort by depth.
        opens = step > 0
        twice = np.repeat(np.arange(len(pos)), 1 + opens)
        marker = np.zeros(len(twice), bool)
        marker[1:] = twice[1:] == twice[:-1]
        level = (depth - opens + (step < 0))[twice] + marker
        level = np.maximum(level, -1)
        order = np.argsort(level.astype(np.int16) if len(level) and level.max() < 1 << 15 else level, kind="stable")  # short numbers sort faster
        t, marker, level = twice[order], marker[order], level[order]
        k = np.where(marker, 0, kind[t])
        here = np.arange(len(t))
        mark = np.maximum.accumulate(np.where(marker, here, -1)) if len(t) else here
        mark[level < 1] = -1
        box = np.where(mark >= 0, t[mark], -1) if len(t) else t
        box_kind = np.where(box >= 0, kind[box], 0) if len(t) else k
        value = (k == _QUOTE) | (k == _LIT) | (k == _OPEN_OBJ) | (k == _OPEN_ARR)
        shut = (k == _CLOSE_OBJ) | (k == _CLOSE_ARR)

        # The grammar, by comparing neighbours within a container.
        same = np.zeros(len(t), bool)
        same[1:] = mark[1:] == mark[:-1]
        prev = np.zeros(len(t), k.dtype)
        prev[1:] = np.where(same[1:], k[:-1], 0)
        in_obj = box_kind == _OPEN_OBJ
        is_key = value & in_obj & ((prev == 0) | (prev == _COMMA))
        done = np.zeros(len(t), bool)  # the neighbour before is a complete value
        done[1:] = same[1:] & value[:-1] & ~is_key[:-1]
        after_key = np.zeros(len(t), bool)
        after_key[1:] = is_key[:-1]
        first = np.zeros(len(t), bool)
        first[1:] = marker[:-1] & same[1:]
        good = marker | np.where(
            level < 1,
            value,
            np.where(
                value,
                np.where(in_obj, np.where(is_key, k == _QUOTE, prev == _COLON), first | (prev == _COMMA)),
                np.where(k == _COLON, in_obj & after_key, np.where(k == _COMMA, done, (done | first) & (k == box_kind + 2))),
            ),
        )
        self.ok[row[t[~good]]] = False
        self.ok &= np.bincount(row[t[(level < 1) & value]], minlength=n) == 1

        # Ends, keys and positions of the values.
        end = np.zeros(len(pos), np.int64)
        strings = np.flatnonzero(kind == _QUOTE)
        closing = np.flatnonzero(quote & ~inside)
        end[strings] = closing[np.searchsorted(closing, pos[strings])] + 1
        lits = np.flatnonzero(kind == _LIT)
        stop = np.flatnonzero(~lit)
        if len(lits):
            end[lits] = stop[np.searchsorted(stop, pos[lits])]
            self.ok[row[lits[~self._literals(pos[lits], end[lits])]]] = False
        commas = np.cumsum(k == _COMMA)
        take = value & ~is_key
        code = np.zeros(len(t), np.int8)
        code[1:] = np.where(k[:-1] == _COLON, -1, 0)
        named = np.flatnonzero(take & (code == -1) & in_obj)
        code[:] = 0
        named = named[named >= 2]
        code[named] = self._codes(pos[t[named - 2]], end[t[named - 2]])
        at = np.where((mark >= 0) & (box_kind == _OPEN_ARR), commas - commas[mark], 0)

        v = np.flatnonzero(take)
        v = v[np.argsort(t[v], kind="stable")]
        v = v[self.ok[row[t[v]]]]
        new = np.full(len(pos) + 1, -1, np.int64)
        new[t[v]] = np.arange(len(v))
        self.row, self.kind, self.start, self.end = row[t[v]], kind[t[v]], pos[t[v]], end[t[v]]
        self.parent, self.at = new[box[v]], at[v]
        self.key = self._settle(code[v])

    def _literals(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which literals are null, true, false or a number; every distinct one is tried once."""
        good = np.zeros(len(start), bool)
        length = end - start
        short = np.flatnonzero(length <= 7)
        padded = np.append(self.buf, np.zeros(8, np.uint8))
        bytes_ = np.zeros((len(short), 8), np.uint8)
        for i in range(7):
            has = length[short] > i
            bytes_[has, i] = padded[start[short[has]] + i]
        bytes_[:, 7] = length[short]
        words, which = np.unique(bytes_.view(np.uint64).ravel(), return_inverse=True)
        fine = [_literal(w[: w[7]]) for w in (int(x).to_bytes(8, "little") for x in words.tolist())]
        good[short] = np.array(fine, bool)[which] if len(short) else False
        for i in np.flatnonzero(length > 7).tolist():
            good[i] = _literal(self.buf[start[i] : end[i]].tobytes())
        return good

    def _codes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), np.int8)
        length = end - start - 2
        for name, code in KEYS.items():
            hit = np.flatnonzero(length == len(name))
            for i, byte in enumerate(name.encode()):
                hit = hit[self.buf[start[hit] + 1 + i] == byte]
            out[hit] = code
        slash = np.flatnonzero(self.buf == 92)  # names with escapes are read
        for i in np.flatnonzero(np.searchsorted(slash, start) < np.searchsorted(slash, end)).tolist():
            out[i] = KEYS.get(_unescaped(self.buf[start[i] : end[i]].tobytes()), 0)
        return out

    def _settle(self, code: np.ndarray) -> np.ndarray:
        """Short codes, each once in an object: of a name written twice the last counts, as JSON readers take it; of a short and a
        long name the short one, unless it is null."""
        named = np.flatnonzero(code > 0)
        for what in (code, code & (LONG - 1)):
            group = self.parent[named] * 16 + what[named]
            null = (self.kind[named] == _LIT) & (self.buf[self.start[named]] == ord("n")) if what is not code else np.zeros(len(named), bool)
            rank = np.lexsort((named, code[named] < LONG, ~null, group))
            last = np.append(group[rank][1:] != group[rank][:-1], True) if len(rank) else np.zeros(0, bool)
            named = np.sort(named[rank[last]])
        out = np.zeros(len(code), np.int8)
        out[named] = code[named] & (LONG - 1)
        return out

    def text(self, values: np.ndarray) -> list[str]:
        """The strings at the given values, unescaped; half a surrogate pair reads as the replacement character."""
        raw = self.buf.tobytes()
        spans = (raw[a:b] for a, b in zip(self.start[values].tolist(), self.end[values].tolist()))
        return [_unescaped(x) if b"\\" in x else x[1:-1].decode("utf-8", "replace") for x in spans]


def _literal(word: bytes) -> bool:
    return word in (b"null", b"true", b"false") or bool(_NUMBER.match(word))


def _unescaped(quoted: bytes) -> str:
    text = json.loads(quoted.decode("utf-8", "replace"))
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") if _SURROGATE.search(text) else text


class Below:
    """The children of chosen values, found by their parents: ``of(front)`` gives those of all values of ``front`` at once."""

    def __init__(self, x: Index, chosen: np.ndarray):
        ids = np.flatnonzero(chosen & (x.parent >= 0))
        self.ids = ids[np.argsort(x.parent[ids], kind="stable")]
        self.parents = x.parent[self.ids]

    def of(self, front: np.ndarray) -> np.ndarray:
        """The children, grouped by parent in the order of ``front`` and in file order within a parent."""
        return self.ids[self.places(front)[0]]

    def places(self, front: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.searchsorted(self.parents, front), np.searchsorted(self.parents, front, "right")
        n = high - low
        return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def top_holders(x: Index) -> np.ndarray:
    """The value that holds the top senses of each document, if any: the document, the senses of an object, else what its
    content holds, however often it is wrapped."""
    objects, arrays = x.kind == _OPEN_OBJ, x.kind == _OPEN_ARR
    senses, content = Below(x, (objects | arrays) & (x.key == SENSES)), Below(x, (objects | arrays) & (x.key == CONTENT))
    found, holder = [np.flatnonzero((x.parent < 0) & arrays)], np.flatnonzero((x.parent < 0) & objects)
    while len(holder):
        found.append(here := senses.of(holder))
        inner = content.of(np.setdiff1d(holder, x.parent[here], assume_unique=True))
        found.append(inner[arrays[inner]])
        holder = inner[objects[inner]]
    return np.concatenate(found)


def walk(x: Index, paths: bool = False) -> tuple[np.ndarray, list, np.ndarray]:
    """The senses of an index, found level by level: with ``paths`` the path of every value that is a sense and, of the senses
    in turn, (path above, position); the senses."""
    n = len(x.kind)
    none = np.zeros(0, np.int64)
    if not n:
        return np.zeros(0, object), [], none
    objects, arrays, inner = x.kind == _OPEN_OBJ, x.kind == _OPEN_ARR, x.parent >= 0
    parent_kind = np.where(inner, x.kind[x.parent], 0)
    elements = Below(x, objects & (parent_kind == _OPEN_ARR))
    nested = Below(x, (objects | arrays) & (x.key == SENSES) & (parent_kind == _OPEN_OBJ))
    front = top_holders(x)
    path_of = np.full(n, None, object)
    above = np.full(n, "", object)  # of a container: the path of the sense that holds it
    ids, levels = [], []
    while len(front):
        alone = front[objects[front]]
        listed = elements.of(front[arrays[front]])
        here = np.concatenate([alone, listed])
        if paths:
            held = np.concatenate([above[alone], above[x.parent[listed]]])
            number = np.concatenate([np.zeros(len(alone), np.int64), x.at[listed]])
            path_of[here] = [f"{p}.{i}" if p else str(i) for p, i in zip(held, number.tolist())]
            levels.append((held, number))
        ids.append(here)
        front = nested.of(here)
        if paths:
            above[front] = path_of[x.parent[front]]
    return path_of, levels, np.concatenate(ids) if ids else none


def _senses(x: Index, text: bool) -> tuple[dict[str, list], int]:
    """The senses and forms of an index, as columns ``row, kind, path, parent, pos`` and the texts; how deep they lie."""
    n = len(x.kind)
    path_of, levels, sense = walk(x, paths=True)
    held = np.concatenate([a for a, _ in levels]) if levels else np.zeros(0, object)
    number = np.concatenate([b for _, b in levels]) if levels else np.zeros(0, np.int64)

    is_sense = np.zeros(n, bool)
    is_sense[sense] = True
    of_sense = (x.parent >= 0) & is_sense[x.parent] if n else is_sense
    grammar = of_sense & (x.key == GRAMMAR) & (x.kind == _OPEN_OBJ)
    in_grammar = (x.parent >= 0) & grammar[x.parent] if n else grammar
    forms = in_grammar & (x.key == FORMS)
    alone = np.flatnonzero(forms & (x.kind == _QUOTE))
    listed = np.flatnonzero((x.parent >= 0) & (x.kind == _QUOTE) & ((forms & (x.kind == _OPEN_ARR))[x.parent] if n else False))
    form = np.concatenate([alone, listed])
    owner = np.concatenate([x.parent[x.parent[alone]], x.parent[x.parent[x.parent[listed]]]]) if n else form
    form_at = np.concatenate([np.zeros(len(alone), np.int64), x.at[listed]])
    form_path = path_of[owner] if n else np.zeros(0, object)

    out = {
        "row": np.concatenate([x.row[sense], x.row[form]]) if n else np.zeros(0, np.int32),
        "kind": ["sense"] * len(sense) + ["form"] * len(form),
        "path": [*path_of[sense], *(f"{p}:{i}" for p, i in zip(form_path, form_at.tolist()))],
        "parent": [*held, *form_path],
        "pos": [*number.tolist(), *form_at.tolist()],
    }
    if text:
        for name, code, where in (("d", TEXT, of_sense), ("n", NUMBER, of_sense), ("vs", STEM, in_grammar)):
            hit = np.flatnonzero(where & (x.key == code) & (x.kind == _QUOTE))
            own = x.parent[hit] if where is of_sense else x.parent[x.parent[hit]]
            column = np.full(n, None, object)
            column[own] = x.text(hit)
            out[name] = [*column[sense], *[None] * len(form)]
        out["form"] = [*[None] * len(sense), *x.text(form)]
    return out, len(levels)


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of at most ``limit`` bytes together, or one longer row."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, start = np.cumsum(size), 0
    while start < len(size):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + limit, "right")))
        yield start, stop
        start = stop


def opened(texts: pa.Array) -> Iterator[tuple[Index, np.ndarray, pa.Array | None]]:
    """Indexes of the texts, chunk by chunk, and the rows of ``texts`` that theirs are; JSON strings that hold JSON again, however
    often, are opened and indexed in the next pass. The texts are given along in the first pass."""
    for start, stop in chunks(texts):
        part, rows, first = texts.slice(start, stop - start), np.arange(start, stop), True
        while len(rows):
            x = Index(pc.fill_null(part, "") if first else part)
            yield x, rows, part if first else None
            inner = np.flatnonzero((x.parent < 0) & (x.kind == _QUOTE))
            part, rows, first = pa.array(x.text(inner), pa.string()), rows[x.row[inner]], False


#: Characters of paths, about, that one output batch holds at most.
_PATH_CHARS = 1 << 26


def _flatten(texts: pa.Array, text: bool) -> Iterator[dict[str, list]]:
    """The rows of a batch, in batches of bounded size; the unreadable texts with the reason."""
    for x, rows, whole in opened(texts):
        found, depth = _senses(x, text)
        found["row"] = rows[found["row"]]
        step = max(1, _PATH_CHARS // (8 * max(depth, 1)))  # deep trees have long paths
        for i in range(0, len(found["row"]), step):
            yield {name: column[i : i + step] for name, column in found.items()}
        lost = np.flatnonzero(~x.ok)
        if len(lost):
            reason = np.full(len(lost), "broken", object)
            if whole is not None:
                bad = whole.take(pa.array(lost))
                reason[pc.equal(pc.utf8_trim_whitespace(pc.fill_null(bad, "")), "").to_numpy(zero_copy_only=False)] = "empty"
                reason[bad.is_null().to_numpy(zero_copy_only=False)] = "null"
            yield {"row": rows[lost], "kind": ["unreadable"] * len(lost), "path": reason.tolist(), "parent": [""] * len(lost), "pos": [0] * len(lost)}


_LINKS = pa.schema([("kind", pa.string()), ("path", pa.string()), ("parent", pa.string()), ("pos", pa.int64())])
_TEXTS = pa.schema([("d", pa.string()), ("n", pa.string()), ("vs", pa.string()), ("form", pa.string())])


def flatten_senses(df: DataFrame, json_col: str | Column, *keep: str, text: bool = False, prefix: str = "") -> DataFrame:
    """One row for each sense and each form of the JSON sense tree in ``json_col``, with the columns ``keep`` of its record.

    Columns added: ``kind`` ('sense', 'form' or 'unreadable'), ``path`` (positions from the top, ``0.2.1``; of a form the path
    of its sense, ``:`` and its position), ``parent`` (the path above, '' at the top), ``pos`` (last position) and, with
    ``text``, ``d``, ``n``, ``vs`` of a sense and ``form``. ``prefix`` is put before all added names; without one it is
    ``sense_`` if a name of ``keep`` is among them.

    Defined cases: a text without a complete JSON document gives one 'unreadable' row whose ``path`` is the reason ('null',
    'empty' or 'broken'; control characters that are not escaped break a document); JSON inside a JSON string is opened, however
    often; so are ``c`` objects around the senses; key names may be escaped; trees may be of any depth. ``null``, numbers and
    strings in place of a sense take a position and give no row; a single object or string in place of an array has position
    0; a document that is ``null``, ``{}`` or a number gives no rows. Of a name written twice in one object the last value
    counts; of the short and the long name the short one, unless it is null. Other columns, and repeated records, have no
    influence.
    """
    names = [*_LINKS.names, *(_TEXTS.names if text else [])]
    prefix = prefix or ("sense_" if {*names} & {*keep} else "")
    out_fields = [pa.field(prefix + f.name, f.type) for f in [*_LINKS, *(_TEXTS if text else [])]]
    src = df.select(*keep, (F.col(json_col) if isinstance(json_col, str) else json_col).cast("string").alias("__json"))
    src = spread(src)
    spark_types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), *(f"`{f.name}` {'bigint' if f.type == pa.int64() else 'string'}" for f in out_fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for found in _flatten(texts, text):
                if not len(found["row"]):
                    continue
                rows = pa.array(found["row"])
                columns = [batch.column(i).take(rows) for i in range(batch.num_columns - 1)]
                blank = [None] * len(found["row"])
                columns += [pa.array(found.get(name, blank), f.type) for name, f in zip(names, out_fields)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *(f.name for f in out_fields)])

    return src.mapInArrow(run, spark_types)


def sense_texts(df: DataFrame, json_col: str, *keep: str, containing: str, out: str = "texts", every: bool = False) -> DataFrame:
    """One row for each record of ``df`` with a definition (``d`` of a sense) that contains ``containing``, in ASCII and
    without regard to case: the columns ``keep`` and all such definitions as an array ``out``, in file order.

    A column ``out`` among ``keep`` is replaced. Reads the sense trees as ``flatten_senses`` does, and finds what a filter over
    its ``d`` finds; unreadable trees, and trees without such a definition, give no row, or with ``every`` a null array.
    """
    keep = tuple(k for k in keep if k != out)
    src = spread(df.select(*keep, F.col(json_col).cast("string").alias("__json")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, list[str]] = {}
            for row, text in _definitions(batch.column(batch.num_columns - 1), containing):
                held.setdefault(row, []).append(text)
            if every:
                held = {row: held.get(row) for row in range(batch.num_rows)}
            if held:
                rows = pa.array(list(held), pa.int64())
                columns = [batch.column(i).take(rows) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.list_(pa.string()))], names=[*batch.schema.names[:-1], out])

    return src.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), f"`{out}` array<string>"]))


def _definitions(texts: pa.Array, containing: str) -> Iterator[tuple[int, str]]:
    """Row and text of the definitions that contain a text. Strings are searched as they are written, and read where they hold it
    or may hold it in escapes."""
    needle = containing.lower().encode()
    escaped = b"\\" if set(containing) & set('"\\/\b\f\n\r\t') else b"\\u"
    wanted = re.compile(re.escape(containing), re.I | re.A)
    for x, rows, _ in opened(texts):
        _, _, sense = walk(x)
        is_sense = np.zeros(len(x.kind) + 1, bool)
        is_sense[sense] = True
        hit = np.flatnonzero(is_sense[x.parent] & (x.key == TEXT) & (x.kind == _QUOTE))
        raw = x.buf.tobytes()
        low = raw.lower()
        spans = zip(x.start[hit].tolist(), x.end[hit].tolist())
        hit = hit[np.fromiter((low.find(needle, a, b) >= 0 or raw.find(escaped, a, b) >= 0 for a, b in spans), bool, len(hit))]
        yield from ((row, text) for row, text in zip(rows[x.row[hit]].tolist(), x.text(hit)) if wanted.search(text))


def rewrite_strings(df: DataFrame, json_col: str, change: Callable[[str], str], containing: str) -> DataFrame:
    """``df`` with the JSON texts of ``json_col`` rewritten: every string at any depth that contains ``containing`` (in ASCII and
    without regard to case) is replaced by what ``change`` makes of it, unescaped; so are strings in JSON that is itself a
    string, however often. All else of a text stays as it is, byte by byte; a text without a complete document stays whole.
    """
    place = df.columns.index(json_col)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = _rewritten(columns[place], change, containing)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return spread(df).mapInArrow(run, types)


def _rewritten(texts: pa.Array, change: Callable[[str], str], containing: str) -> pa.Array:
    needle, wanted = containing.lower().encode(), re.compile(re.escape(containing), re.I | re.A)
    escaped = b"\\" if set(containing) & set('"\\/\b\f\n\r\t') else b"\\u"
    likely = pc.or_(pc.match_substring(texts, containing, ignore_case=True), pc.match_substring(texts, escaped.decode()))
    rows = np.flatnonzero(pc.fill_null(likely, False).to_numpy(zero_copy_only=False))
    new: dict[int, str] = {}
    some = texts.take(pa.array(rows))
    for start, stop in chunks(some):
        x = Index(some.slice(start, stop - start))
        raw = x.buf.tobytes()
        low = raw.lower()
        strings = np.flatnonzero(x.kind == _QUOTE)
        ends = np.append(np.flatnonzero(np.diff(x.row[strings])) + 1, len(strings))
        begin = 0
        bounds = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(some.slice(start, stop - start)), 0).to_numpy(zero_copy_only=False) + 1))
        for end in ends.tolist() if len(strings) else []:
            row = int(x.row[strings[begin]])
            parts, at = [], int(bounds[row])
            for v in strings[begin:end].tolist():
                a, b = int(x.start[v]), int(x.end[v])
                if low.find(needle, a, b) < 0 and raw.find(escaped, a, b) < 0:
                    continue
                text = _unescaped(raw[a:b])
                if not wanted.search(text):
                    continue
                made = _rewritten(pa.array([text]), change, containing)[0].as_py() if x.parent[v] < 0 else text
                made = change(text) if made == text else made
                if made != text:
                    parts += [raw[at:a], json.dumps(made, ensure_ascii=raw[a:b].isascii()).encode()]
                    at = b
            if parts:
                new[int(rows[start + row])] = (b"".join(parts) + raw[at : int(bounds[row + 1]) - 1]).decode("utf-8", "replace")
            begin = end
    if not new:
        return texts
    at = np.array(sorted(new))
    mask = np.zeros(len(texts), bool)
    mask[at] = True
    return pc.replace_with_mask(texts, pa.array(mask), pa.array([new[i] for i in at.tolist()], texts.type))
