"""Byte-level BPE encoding of whole columns with a public vocabulary.

The texts of an Arrow batch are one buffer. Pre-token boundaries come from comparing the classes of neighbouring code
points over all of it at once; the pre-tokens tile the buffer, so its dictionary of distinct pre-tokens needs no copy.
Distinct pre-tokens are resolved in two tiers: a minimal perfect hash, built level by level over the vocabulary, resolves
those that are whole entries (the bytes are compared, so a hit is exact); the others are merged by a heap over linked bytes
and remembered in a bounded memo. The operator is one narrow stage: no shuffle, no row-wise Python over texts.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.nested import chunks
from ..session import spread, tokenizer_dir

#: Bytes of text that are encoded at once, and distinct merged pre-tokens that a worker remembers.
CHUNK, MEMO = 2_000_000, 1 << 17

LETTER, NUMBER, OTHER, BLANK = range(4)

#: White space, by Unicode's property.
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def default_vocabulary() -> str:
    return f"{tokenizer_dir()}/byte_bpe_50k.tiktoken"


def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            table[np.frombuffer(m.group().encode("utf-32-le"), np.uint32)] = kind
    table[_SPACES] = BLANK
    return table


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys: at each level the keys that are alone in their slot stay, the others
    go on to the next; the number of a key is the rank of its slot."""

    def __init__(self, keys: np.ndarray, spread: float = 2.0):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # slot taken, rank of the slot
        done = 0
        while len(keys):
            if len(self.levels) > 60:
                raise ValueError("keys are not distinct")
            slot = self._slot(keys, len(self.levels), size := max(64, int(len(keys) * spread)))
            taken = np.bincount(slot, minlength=size) == 1
            self.levels.append((taken, (done + np.cumsum(taken) - 1).astype(np.int32)))
            done += int(taken.sum())
            keys = keys[~taken[slot]]
        self.size = done

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key of the set; of other keys any number, or -1."""
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        for level, (taken, rank) in enumerate(self.levels):
            slot = self._slot(keys[open_], level, len(taken))
            hit = taken[slot]
            out[open_[hit]] = rank[slot[hit]]
            open_ = open_[~hit]
        return out


class Vocabulary:
    """Ranks of byte strings (file: base64, space, rank), the perfect hash over them, and the merges of what is not among them."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.words = [base64.b64decode(a) for a, _ in pairs]
        self.ids = np.array([int(b) for _, b in pairs], np.int32)
        self.ranks = dict(zip(self.words, self.ids.tolist()))
        self.length = np.zeros(int(self.ids.max()) + 1, np.int64)
        self.length[self.ids] = [len(w) for w in self.words]
        self.classes = _classes()
        self._powers = np.ones(64, np.uint64)
        keys = self._keys(pa.array(self.words, pa.binary()))
        self.hash = PerfectHash(keys)
        self.at = np.zeros(self.hash.size, np.int32)  # word by number
        self.at[self.hash.find(keys)] = np.arange(len(keys))
        self.memo: dict[bytes, list[int]] = {}

    def _keys(self, words: pa.Array) -> np.ndarray:
        """64-bit polynomial keys of non-empty byte strings."""
        off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        if len(off) < 2:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(words.buffers()[2], np.uint8)[off[0] : off[-1]]
        size = np.diff(off)
        if size.max() > len(self._powers):
            n = 1 << int(size.max()).bit_length()
            powers = np.full(n, 0x100000001B3, np.uint64)
            powers[0] = 1
            self._powers = np.multiply.accumulate(powers)
        place = np.arange(len(data)) - np.repeat(off[:-1] - off[0], size)
        with np.errstate(over="ignore"):
            return np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * self._powers[place], off[:-1] - off[0])

    def merge(self, word: bytes) -> list[int]:
        """The ids of a byte string: a heap of the mergeable neighbours, lowest rank and leftmost first, over linked parts."""
        ranks, n = self.ranks, len(word)
        after, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], bytearray(b"\1") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or after[j] != end:
                continue
            after[i], alive[j] = end, 0
            if end < n:
                before[end] = i
                if (r := ranks.get(word[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (p := before[i]) >= 0 and (r := ranks.get(word[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : after[i]]])
            i = after[i]
        return out

    def resolve(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct byte strings, one after the other, and how many each has."""
        found = self.hash.find(self._keys(words))
        held = words.to_pylist()
        known, at, ids = self.words, self.at, self.ids
        parts, counts = [], np.ones(len(held), np.int64)
        for i, (word, number) in enumerate(zip(held, found.tolist())):
            if number >= 0 and known[w := at[number]] == word:
                parts.append((ids[w],))
                continue
            merged = self.memo.get(word)
            if merged is None:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                merged = self.memo[word] = self.merge(word)
            parts.append(merged)
            counts[i] = len(merged)
        return np.fromiter((x for p in parts for x in p), np.int32, int(counts.sum())), counts


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once in a worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


class Encoded:
    """The encoding of a chunk of texts (null reads as empty).

    ``doc_tokens``: number of tokens of each text; ``ids``: all ids in order; ``ends()``: the byte after each token, from the
    start of the chunk. ``data``, ``offsets``: the bytes, and where each text begins."""

    def __init__(self, texts: pa.Array, voc: Vocabulary):
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = memoryview(texts.buffers()[2] or b"")[int(off[0]) : int(off[-1])]
        try:
            wide = str(raw, "utf-8")
        except UnicodeDecodeError:  # broken bytes read as the replacement character
            mended = [str(raw[a - off[0] : b - off[0]], "utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            self.__init__(pa.array(mended, pa.large_string()), voc)
            return
        self.offsets = off = off - off[0]
        self.data = data = np.frombuffer(raw, np.uint8)
        self.point = point = np.frombuffer(wide.encode("utf-32-le"), np.uint32)
        self.lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte of each code point
        self.kind = kind = voc.classes[point]
        first = np.searchsorted(self.lead, off)
        self.doc_start = np.zeros(len(point) + 1, bool)
        self.doc_start[first] = True
        self.start = self._starts(point, kind, self.doc_start)
        at = np.flatnonzero(self.start)
        self.word_off = np.append(self.lead[at], len(data)).astype(np.int32)
        self.words = len(at)
        if not self.words:
            self.ids, self.sizes, self.doc_tokens = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(n, np.int64)
            return
        coded = pa.Array.from_buffers(pa.binary(), self.words, [None, pa.py_buffer(self.word_off), pa.py_buffer(data)]).dictionary_encode()
        which = coded.indices.to_numpy()
        flat, counts = voc.resolve(coded.dictionary)
        self.sizes = sizes = counts[which]
        done = np.cumsum(sizes)
        begin = np.cumsum(counts) - counts
        self.ids = flat[np.repeat(begin[which] - (done - sizes), sizes) + np.arange(done[-1])]
        upto = np.append(0, done)[np.searchsorted(self.word_off[:-1], off)]
        self.doc_tokens = np.diff(upto)

    @staticmethod
    def _starts(point: np.ndarray, kind: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin: contractions; runs of letters, of numbers, of other signs, each with one space before it;
        white space, whose last sign before something else stands alone."""
        start = doc[:-1].copy()
        if not len(point):
            return start
        start[1:] |= kind[1:] != kind[:-1]
        blank, space = kind == BLANK, point == 32
        j = np.flatnonzero(start & ~blank & ~doc[:-1])
        j = j[blank[j - 1]]
        start[j - 1] = True
        start[j[space[j - 1]]] = False
        a = np.flatnonzero((point == 39) & start)
        a = a[a + 1 < len(point)]
        a = a[~doc[a + 1] & (kind[a + 1] == LETTER)]
        if len(a):
            one = point[a + 1]
            two = np.where(doc[np.minimum(a + 2, len(point))], 0, point[np.minimum(a + 2, len(point) - 1)])
            length = np.where(np.isin(one, [100, 109, 115, 116]), 1, np.where(((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)), 2, 0))
            a, length = a[length > 0], length[length > 0]
            start[a + 1] = False
            k = a + 1 + length
            k = k[k < len(point)]
            start[k[~doc[k] & (kind[k] == LETTER)]] = True
        return start

    def ends(self, voc: Vocabulary) -> np.ndarray:
        """The byte after each token."""
        return np.cumsum(voc.length[self.ids])


def _run(df: DataFrame, text_col: str, keep: tuple[str, ...], added: list[pa.Field], spark_types: str, path: str | None, make) -> DataFrame:
    """Map the texts chunk by chunk; ``make(encoded, vocabulary)`` gives the added columns, one value for each text."""
    path = path or default_vocabulary()
    keep = tuple(k for k in keep if k not in {f.name for f in added})
    src = spread(df.select(*keep, F.col(text_col).cast("string").alias("__text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in chunks(texts, CHUNK):
                part = batch.slice(a, b - a)
                more = make(Encoded(texts.slice(a, b - a), voc), voc)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(batch.num_columns - 1)), *more], names=[*batch.schema.names[:-1], *(f.name for f in added)])

    return src.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), spark_types]))


def encode(df: DataFrame, text_col: str, *keep: str, out: str = "ids", path: str | None = None) -> DataFrame:
    """The columns ``keep`` of every row and ``out``, the ids of its text without special tokens.

    Defined cases: null and empty texts have an empty list; strings of special tokens are ordinary text; broken UTF-8 reads
    as U+FFFD; repeated texts are encoded alike; a text of any length is one unit and is never shortened; a column ``out`` among
    ``keep`` is replaced.
    """

    def make(x: Encoded, voc: Vocabulary) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(x.doc_tokens)).astype(np.int32)), pa.array(x.ids))]

    return _run(df, text_col, keep, [pa.field(out, pa.list_(pa.int32()))], f"`{out}` array<int>", path, make)


def count_tokens(df: DataFrame, text_col: str, *keep: str, out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """The columns ``keep`` of every row and ``out``, the number of tokens of its text (0 for null and empty texts)."""
    return _run(df, text_col, keep, [pa.field(out, pa.int64())], f"`{out}` bigint", path, lambda x, voc: [pa.array(x.doc_tokens)])
