"""How an entry is shown: its senses in order with kind and level, its badges, its references.

The senses shown are found where the structural index of a tree is at hand, level by level over all trees of an Arrow batch:
one narrow stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.display import GENDERS, LANGUAGES, SPEECH, badge, sense_number
from ..session import spread
from .nested import FORMS, GRAMMAR, NUMBER, SENSES, STEM, TEXT, Below, Index, opened, top_holders, walk

#: Order of the categories of references shown, and how many are shown at first.
CATEGORIES, FIRST_SHOWN = ("t", "b", "mi", "o"), 10

_KINDS = ("language", "primary", "numbered", "plain", "grammar")
_LANGUAGE, _PRIMARY, _NUMBERED, _PLAIN, _GRAMMAR = range(5)
_QUOTE, _OPEN_OBJ, _OPEN_ARR = ord('"'), ord("{"), ord("[")


def _held(x: Index, code: int, counts: np.ndarray) -> np.ndarray:
    """Of each value the place of its value named ``code`` among those that ``counts``, or -1."""
    out = np.full(len(x.kind) + 1, -1, np.int64)
    hit = np.flatnonzero((x.key == code) & (x.parent >= 0) & counts)
    out[x.parent[hit]] = hit
    return out[:-1]


def _render(x: Index, info_of: np.ndarray) -> dict[str, np.ndarray]:
    """What is shown of the trees of an index, in order: ``node, kind, level, info`` (whether the language line is shown there).
    ``info_of`` tells which rows have such a line."""
    n = len(x.kind)
    none = np.zeros(0, np.int64)
    if not n:
        return {"node": none, "kind": none, "level": none, "info": none.astype(bool)}
    objects, arrays = x.kind == _OPEN_OBJ, x.kind == _OPEN_ARR
    filled = (x.kind == _QUOTE) & (x.end - x.start > 2)
    first_byte = x.buf[x.start]
    truthy = objects | arrays | filled | ((x.kind == ord("v")) & ~np.isin(first_byte, [ord("n"), ord("f")]) & ~((first_byte == ord("0")) & (x.end - x.start == 1)))
    d, num, g = (_held(x, code, which) >= 0 for code, which in ((TEXT, filled), (NUMBER, filled), (GRAMMAR, truthy)))
    below = _held(x, SENSES, objects | arrays)
    elements = Below(x, objects & np.where(x.parent >= 0, arrays[x.parent], False))
    size = np.bincount(elements.parents, minlength=n)
    size[objects] = 1
    has_below = (below >= 0) & (size[below] > 0)

    def listed(holders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The senses in holders, and which holder each is in."""
        places, count = elements.places(np.where(arrays[holders], holders, -2))
        who = np.concatenate([np.repeat(np.arange(len(holders)), count), np.flatnonzero(objects[holders])])
        what = np.concatenate([elements.ids[places], holders[objects[holders]]])
        order = np.argsort(who, kind="stable")
        return what[order], who[order]

    holders = top_holders(x)
    holders = holders[size[holders] > 0]
    level, info, prefix = np.zeros(len(holders), np.int64), info_of[x.row[holders]], [b""] * len(holders)
    out: dict[str, list] = {"node": [], "kind": [], "level": [], "info": [], "key": []}
    while len(holders):
        node, call = listed(holders)
        starts = np.flatnonzero(np.append(True, call[1:] != call[:-1]))
        count = np.diff(np.append(starts, len(call)))
        place = np.arange(len(call)) - np.repeat(starts, count)
        head = node[starts]
        grouped = d[head] & ~num[head] & ~g[head] & (count > 1)
        line = ~grouped & info & num[head]  # a line of its own before the list
        of, rest = grouped[call], grouped[call] & (place > 0)
        can = ~of & (info & ~line)[call] & np.where(g[node], has_below[node], d[node])
        before = np.cumsum(can) - can
        takes = can & (before == np.repeat(before[starts], count))
        emit = [
            (starts[line], _LANGUAGE, 0, 0, np.ones(int(line.sum()), bool)),
            (starts[grouped], _PRIMARY, 0, 0, info[grouped]),
        ]
        for which, extra, flag in ((rest & d[node] & num[node], 1, 1), (rest & g[node], 0, 2), (~of, 0, 1)):
            sections, plain = which & g[node], which & ~g[node] & d[node]
            emit.append((np.flatnonzero(sections), _GRAMMAR, extra, flag, np.zeros(int(sections.sum()), bool)))
            if flag == 1:
                emit.append((np.flatnonzero(plain & num[node]), _NUMBERED, extra, flag, takes[plain & num[node]]))
                emit.append((np.flatnonzero(plain & ~num[node]), _PLAIN, extra, flag, takes[plain & ~num[node]]))
        next_holders, next_level, next_info, next_prefix = [], [], [], []
        for at, kind, extra, flag, shows in emit:
            keys = [prefix[c] + bytes((flag,)) + p.to_bytes(4, "big") for c, p in zip(call[at].tolist(), place[at].tolist())]
            levels = level[call[at]] + extra
            out["node"].append(node[at])
            out["kind"].append(np.full(len(at), kind))
            out["level"].append(levels)
            out["info"].append(shows)
            out["key"] += keys
            if kind == _GRAMMAR:
                more = has_below[node[at]]
                next_holders.append(below[node[at[more]]])
                next_level.append(levels[more] + 1)
                next_info.append(takes[at[more]])
                next_prefix += [k for k, m in zip(keys, more.tolist()) if m]
        holders, level, info, prefix = np.concatenate(next_holders), np.concatenate(next_level), np.concatenate(next_info), next_prefix
    if not out["node"]:
        return {"node": none, "kind": none, "level": none, "info": none.astype(bool)}
    keys = out.pop("key")
    found = {name: np.concatenate(parts) for name, parts in out.items()}
    rows = x.row[found["node"]].tolist()
    order = np.array(sorted(range(len(keys)), key=lambda i: (rows[i], keys[i])), np.int64)
    return {name: column[order] for name, column in found.items()}


def _strings(x: Index, chosen: np.ndarray) -> list[str | None]:
    """The texts of values, null for -1."""
    out: list[str | None] = [None] * len(chosen)
    at = np.flatnonzero(chosen >= 0)
    for i, text in zip(at.tolist(), x.text(chosen[at])):
        out[i] = text
    return out


def _shown(x: Index, info_of: np.ndarray) -> dict[str, list]:
    """The columns of what is shown."""
    found = _render(x, info_of)
    node, kind = found["node"], found["kind"]
    if not len(node):
        return {"row": node}
    paths, _, _ = walk(x, paths=True)
    objects, strings = x.kind == _OPEN_OBJ, x.kind == _QUOTE
    text, number = (_held(x, c, strings & (x.end - x.start > 2)) for c in (TEXT, NUMBER))
    grammar, stem, forms = _held(x, GRAMMAR, objects), _held(x, STEM, strings), _held(x, FORMS, strings | (x.kind == _OPEN_ARR))
    of = np.where(kind == _GRAMMAR, grammar[node], -1)
    held = np.where(of >= 0, forms[of], -1)
    items = Below(x, strings & np.where(x.parent >= 0, x.kind[x.parent] == _OPEN_ARR, False))
    joined: list[str | None] = _strings(x, np.where((held >= 0) & strings[held], held, -1))
    many = np.flatnonzero((held >= 0) & ~strings[held])
    places, count = items.places(held[many])
    texts, stop = x.text(items.ids[places]), np.cumsum(count)
    for i, a, b in zip(many.tolist(), (stop - count).tolist(), stop.tolist()):
        joined[i] = ", ".join(texts[a:b])
    row = x.row[node]
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    place = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
    return {
        "row": row, "path": paths[node].tolist(), "kind": [_KINDS[k] for k in kind.tolist()], "level": found["level"].tolist(), "number": _strings(x, np.where(kind == _NUMBERED, number[node], -1)),
        "text": _strings(x, np.where((kind == _GRAMMAR) | (kind == _LANGUAGE), -1, text[node])), "stem": _strings(x, np.where(of >= 0, stem[of], -1)), "forms": joined, "place": place.tolist(), "info": found["info"].tolist(),
    }


_COLUMNS = pa.schema([("path", pa.string()), ("kind", pa.string()), ("level", pa.int32()), ("number", pa.string()), ("text", pa.string()), ("stem", pa.string()), ("forms", pa.string()), ("place", pa.int32()), ("shows", pa.bool_())])


def shown_senses(entries: DataFrame, key: str = "seq") -> DataFrame:
    """What is shown of each entry's senses: ``kind`` (primary, numbered, plain, grammar, language), ``level``, ``number``,
    ``text``, ``stem``, ``forms``, ``place`` (0 for what is shown first) and ``info`` (the language line, where it is shown).

    Of siblings whose first has a text but neither number nor grammar, that one is primary; of the others, numbered ones are
    shown one level deeper and then those with grammar at the same level, so that a sense with number, text and grammar is
    shown in both places; the rest is left out. Otherwise all with grammar or text are shown. Senses below another are shown
    only if it has grammar (any value but null, false, 0 and '': also an empty object). The language line is shown with the
    primary sense; else on its own before a list whose first sense has a number; else a section passes it on to the senses
    below it, and without any to the next sense.
    """
    src = spread(entries.select(key, "li", F.col("c").cast("string").alias("__json")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = pc.fill_null(pc.greater(pc.utf8_length(batch.column(1)), 0), False).to_numpy(zero_copy_only=False)
            for x, rows, _ in opened(batch.column(2)):
                found = _shown(x, lines[rows])
                if len(found["row"]):
                    at = pa.array(rows[found["row"]])
                    columns = [pa.array(found["info" if f.name == "shows" else f.name], f.type) for f in _COLUMNS]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *columns], names=[*batch.schema.names[:2], *_COLUMNS.names])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:2])
    rows = src.mapInArrow(run, types + ", path string, kind string, level int, number string, text string, stem string, forms string, place int, shows boolean")
    return rows.select(key, "path", "kind", "level", sense_number(F.trim("number")).alias("number"), "text", "stem", "forms", "place", F.when(F.col("shows"), F.col("li")).alias("info"))


def contents(entries: DataFrame, key: str = "seq") -> DataFrame:
    """Of each entry the number of senses and of those shown, and the message shown in their place: no tree at all, or nothing
    to show. One narrow stage."""
    src = spread(entries.select(key, F.col("c").cast("string").alias("__json")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((2, n), np.int64)
            for x, rows, _ in opened(batch.column(1)):
                for i, nodes in enumerate((walk(x)[2], _render(x, np.zeros(len(rows), bool))["node"])):
                    counts[i] += np.bincount(rows[x.row[nodes]], minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts[0]), pa.array(counts[1])], names=[key, "senses", "shown"])

    all_ = src.mapInArrow(run, f"`{key}` {src.schema[key].dataType.simpleString()}, senses bigint, shown bigint")
    return all_.withColumn("message", F.when(F.col("senses") == 0, "No content available").when(F.col("shown") == 0, "No definition available"))


def badges(entries: DataFrame, key: str = "seq") -> DataFrame:
    """The badges of each entry, in order: ``place, label, tooltip``; unknown codes have none."""
    each = F.array(*(F.struct(F.lit(i).alias("place"), badge(F.col(f"g.{c}"), t).alias("b")) for i, (c, t) in enumerate((("l", LANGUAGES), ("ps", SPEECH), ("gn", GENDERS)))))
    return entries.select(key, F.explode(each).alias("x")).where("x.b is not null").select(key, "x.place", "x.b.label", "x.b.tooltip")


def shown_references(entries: DataFrame, key: str = "seq") -> DataFrame:
    """The references of each entry in the order shown: ``place, category, ref, visible`` (the first ten)."""

    def listed(c: str):
        return F.transform(F.coalesce(F.try_element_at("rf", F.lit(c)), F.array()), lambda r: F.struct(F.lit(c).alias("category"), r.alias("ref")))

    lists = [listed(c) for c in CATEGORIES]
    each = entries.select(key, F.posexplode(F.filter(F.concat(*lists), lambda x: x.ref.isNotNull())).alias("place", "x"))
    return each.select(key, "place", "x.category", "x.ref", (F.col("place") < FIRST_SHOWN).alias("visible"))
