"""The graph and its layout on small fixtures."""

import pytest
from pyspark.sql import functions as F

from lexigraph.lexicon import SageGraph
from lexigraph.operators import graph, layout

SCHEMA = "pos long, id string, name struct<en:string,he:string>, era string, generation int, location string, dates struct<born:int,died:int,approximate:boolean>, relationships array<struct<type:string,target:string,note:string>>"


def sage(pos, id_, rels=(), era="tanna", gen=1, loc="israel", born=None, en=None):
    return (pos, id_, (en or id_, "א" if id_ else None), era, gen, loc, (born, None, None), [(t, x, None) for t, x in rels] if rels is not None else None)


@pytest.fixture(scope="module")
def sages(spark):
    rows = [sage(0, "a", [("teacher", "b"), ("teacher", "x"), ("odd", "c")]), sage(1, "b", [("student", "a"), ("sibling", "c")]), sage(2, "c", [("father", "a"), ("teacher", None)]), sage(3, "d", None, "amorai", loc="bavel"), sage(4, "d", [], "amorai", loc=None), sage(5, None, [])]
    return spark.createDataFrame(rows, SCHEMA)


def test_adjacency(sages):
    got = sorted((r.src, r.dst or "", r.type, r.inverse) for r in graph.adjacency(sages).collect())
    assert got == [("a", "b", "teacher", False), ("a", "b", "teacher", True), ("a", "c", "odd", False), ("a", "c", "son", True), ("a", "x", "teacher", False), ("b", "a", "student", False), ("b", "a", "student", True), ("b", "c", "sibling", False), ("c", "", "teacher", False), ("c", "a", "father", False), ("c", "b", "sibling", True)]
    grouped = {(r.src, r.type): (r.n, list(r.ids)) for r in graph.grouped_neighbours(sages).collect()}
    assert grouped[("a", "teacher")] == (2, ["b", "b"]) and ("a", "odd") in grouped and len(grouped) == 7


def test_edges_once(sages):
    got = {(r.src, r.dst, r.type) for r in graph.edges(sages).collect()}
    assert got == {("a", "b", "teacher"), ("a", "x", "teacher"), ("a", "c", "odd"), ("b", "a", "student"), ("b", "c", "sibling"), ("c", "a", "father")}
    assert {(r.src, r.dst) for r in graph.visible_edges(sages).collect()} == {("a", "b"), ("b", "a"), ("b", "c"), ("c", "a")}
    assert {(r.src, r.dst) for r in graph.visible_edges(sages, classes=["sibling"]).collect()} == {("b", "c")}


def test_highlight(spark, sages):
    chosen = spark.createDataFrame([("a",), ("d",), ("zz",)], "id string")
    assert {(r.chosen, r.id, r.selected) for r in graph.highlight_nodes(sages, chosen).collect()} == {("a", "a", True), ("a", "b", False), ("a", "c", False)}
    assert {(r.src, r.dst) for r in graph.highlight_edges(sages, chosen).collect()} == {("a", "b"), ("b", "a"), ("b", "c"), ("c", "a")}


def test_vertices_filters_and_rules(sages):
    assert {(r.id, r.pos) for r in graph.vertices(sages).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 4)}
    assert graph.search_names(sages, "B").count() == 1 and graph.search_names(sages, "").count() == 0 and graph.search_names(sages, "א").count() == 5
    assert graph.of_era(sages, "all").count() == 6 and graph.of_era(sages, "amorai").count() == 2
    rules = {(r.id, r.rule, r.value) for r in graph.violations(sages).collect()}
    assert {("a", "unknown target", "x"), ("c", "unknown target", None), ("d", "repeated id", "2"), ("d", "missing location", None), (None, "missing id", None), (None, "missing name.he", None)} <= rules
    view = SageGraph(sages)
    assert view.toggled("tanna").groups == ("tanna",) and view.toggled("amorai-bavel").toggled("tanna").groups == ("amorai-bavel",)


def test_layout(spark):
    rows = [sage(i, f"s{i}", born=b, en=e) for i, (b, e) in enumerate([(5, "z"), (None, "y"), (0, "x"), (5, "a"), (-3, "q"), (9, "r"), (9, "r")])] + [sage(7, "w", era="tanna", gen=2), sage(8, "v", era="tanna", gen=2, loc="bavel"), sage(9, "u", gen=9)]
    sages = spark.createDataFrame(rows, SCHEMA)
    p = {r.id: (r["rank"], r.x, r.y) for r in layout.positions(sages).collect()}
    israel = 30 + 300 + 40
    assert p == {"s4": (1, israel, 40), "s2": (2, israel + 152, 40), "s1": (3, israel + 304, 40), "s3": (4, israel + 456, 40), "s0": (5, israel + 608, 40), "s5": (6, israel, 96), "s6": (7, israel + 152, 96), "w": (1, israel, 160), "v": (1, 30, 160)}
    heights = layout.row_heights(graph.visible(sages))
    assert [r.y for r in heights.orderBy("row").collect()][:3] == [40, 160, 238]
    assert layout.columns(graph.visible(sages)).first().total_width == israel + 760 + 30
    placed = layout.positions(sages)
    assert tuple(layout.bounding_box(placed).first()) == (30, 40, israel + 608 + 140, 204)
    assert layout.bounding_box(placed.limit(0)).count() == 0 and layout.centred(placed, "nobody", 100, 100).count() == 0
    assert tuple(layout.centred(placed, "v", 800, 600).first()) == ("v", 400 - 100.0, 300 - 182.0)
    assert layout.initial_view(placed, 500.0).first().scale == pytest.approx(min(500 / (israel + 748 - 30 + 40), 0.8) * 0.9)
    years = spark.createDataFrame([(-50,), (-10,), (30,), (430,), (-51,)], "year int")
    assert {r.year: r["at"] for r in layout.year_heights(years, heights).collect()} == {-50: 40.0, -10: 100.0, 30: 160.0, 430: None, -51: None}
    assert {r["at"] for r in layout.year_heights(years, heights, strict=True).collect()} == {None}
    assert len({(x, y) for _, x, y in p.values()}) == len(p)
    assert layout.edge_curves(sages).count() == 0 and graph.statistics(sages).where(F.col("kind") == "era").first().n == 10
