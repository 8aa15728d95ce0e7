"""The engine's front: a lexicon over loaded tables. Every method gives a DataFrame. Most
run nothing until it is asked for; batches of nearest keys, layouts and windows by page run small jobs first (``session.cut``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .operators import graph, index, layout, paging, search, senses
from .session import table
from .sources.jsonl import read_lines


class Lexicon:
    """Entries with their keys, and lookups over them.

    ``entries`` needs ``seq, id, hw, p, rf`` and ``c``; build one with ``from_tables`` (parquet) or ``from_lines`` (JSON lines).
    For repeated lookups over large data, ``store`` it and open it with ``from_store``: prefixes and ranges of the key are then
    pushed into the scan.
    """

    def __init__(self, entries: DataFrame, keyed: bool = False):
        self.entries = entries if keyed else index.with_keys(entries)
        self.refs = index.entry_refs(self.entries)

    @classmethod
    def from_tables(cls, spark: SparkSession, folder: str) -> Lexicon:
        return cls(table(spark, folder, "entries"))

    @classmethod
    def from_lines(cls, spark: SparkSession, paths: str | Sequence[str]) -> Lexicon:
        return cls(read_lines(spark, paths)[0])

    @classmethod
    def from_store(cls, spark: SparkSession, path: str) -> Lexicon:
        return cls(spark.read.parquet(path), keyed=True)

    def store(self, path: str) -> None:
        index.store_keyed(self.entries, path)

    def nearest(self, query: str | DataFrame) -> DataFrame:
        """Rows of the nearest key; for a DataFrame of queries (column ``query``) their keys."""
        return search.nearest(self.entries, query) if isinstance(query, str) else search.nearest_batch(self.entries, query)

    def prefix_headwords(self, query: str | DataFrame, limit: int = 8) -> DataFrame:
        return (search.prefix_headwords if isinstance(query, str) else search.prefix_headwords_batch)(self.entries, query, limit=limit)

    def prefix_references(self, query: str | DataFrame, limit: int = 8) -> DataFrame:
        return (search.prefix_references if isinstance(query, str) else search.prefix_references_batch)(index.sorted_references(self.refs), query, limit=limit)

    def by_reference(self, query: str | DataFrame) -> DataFrame:
        return search.by_reference(self.entries, self.refs, query) if isinstance(query, str) else search.by_reference_batch(self.refs, query)

    def page(self, number: int) -> DataFrame:
        return paging.on_page(self.entries, number)

    def page_start(self, number: int) -> DataFrame:
        return paging.page_start(self.entries, number)

    def window(self, page: int, ordinal: int = -1) -> DataFrame:
        return paging.initial_window(self.entries, page, ordinal)

    def range(self, start: int, count: int) -> DataFrame:
        return paging.rows_range(self.entries, start, count)

    def by_id(self, ids: DataFrame) -> DataFrame:
        return search.by_id(self.entries, ids)

    def ordinal(self, ids: DataFrame) -> DataFrame:
        return search.ordinal(self.entries, ids)

    def count(self) -> int:
        return self.entries.count()

    def shown(self) -> DataFrame:
        return senses.shown_senses(self.entries)


class SageGraph:
    """The relationship graph and its layout over a table of sages (``pos, id, name, era, generation, location, dates,
    relationships``)."""

    def __init__(self, sages: DataFrame, groups: Sequence[str] = ("tanna",), classes: Sequence[str] = tuple(graph.CLASSES)):
        self.sages, self.groups, self.classes = sages, tuple(groups), tuple(classes)

    def with_filters(self, groups: Sequence[str] | None = None, classes: Sequence[str] | None = None) -> SageGraph:
        """Another view; a set of groups or classes is never left empty (then it stays as it is)."""
        return SageGraph(self.sages, groups or self.groups, classes or self.classes)

    def toggled(self, group: str) -> SageGraph:
        """The view with a group added or taken away; the last group stays."""
        return self.with_filters([g for g in self.groups if g != group] if group in self.groups else [*self.groups, group])

    def by_id(self, sage: str) -> DataFrame:
        return graph.vertices(self.sages).where(graph.F.col("id") == sage)

    def relationships(self, sage: str | None = None) -> DataFrame:
        all_ = graph.adjacency(self.sages)
        return all_ if sage is None else all_.where(graph.F.col("src") == sage)

    def grouped(self) -> DataFrame:
        return graph.grouped_neighbours(self.sages)

    def edges(self) -> DataFrame:
        return graph.edges(self.sages)

    def visible_edges(self) -> DataFrame:
        return graph.visible_edges(self.sages, self.groups, self.classes)

    def search(self, query: str) -> DataFrame:
        return graph.search_names(self.sages, query)

    def of_era(self, era: str) -> DataFrame:
        return graph.of_era(self.sages, era)

    def highlight(self, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
        return graph.highlight_nodes(self.sages, chosen, self.groups), graph.highlight_edges(self.sages, chosen, self.groups, self.classes)

    def positions(self) -> DataFrame:
        return layout.positions(self.sages, self.groups)

    def curves(self) -> DataFrame:
        return layout.edge_curves(self.sages, self.groups)

    def violations(self) -> DataFrame:
        return graph.violations(self.sages)

    def statistics(self) -> DataFrame:
        return graph.statistics(self.sages)
