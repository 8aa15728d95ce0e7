"""Queries of the load path: tables written out by the library's writers and read back by its readers, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import FINALS, ORDINARY
from ..session import shared_folder, table
from ..sources import documents, jsonl
from ..sources.cache import SnapshotStore, load
from ..streaming import ingest


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/load-{uuid.uuid4().hex}"


def loaded_lines(spark: SparkSession, d: str) -> DataFrame:
    """Entries as JSON lines in two parts, read with ordinals over both parts."""
    entries, folder = table(spark, d, "entries").drop("loaded_at"), _folder(spark)
    jsonl.write_lines(entries, folder)
    rows, _ = jsonl.read_lines(spark, [f"{folder}/part={n}" for n in (1, 2)])
    return rows.select("seq", "part", "id", "hw", "p", "c", F.size("ah").alias("others"))


def malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines that are no entry: here the unreadable sense trees, written as lines of their own between good ones."""
    folder = _folder(spark)
    trees = table(spark, d, "entries").where("c is not null and trim(c) <> '' and not c like '%\n%'")
    trees.where("c like '{%'").select("c").write.text(folder)
    return jsonl.read_lines(spark, folder)[1].groupBy("part").agg(F.count("*").alias("n"))


def stored_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Annotations fetched, stored under a version, and read from the store when the version is served again."""
    store = SnapshotStore(spark, _folder(spark))
    notes = table(spark, d, "annotations")
    load(store, "annotations", lambda: "v1", lambda: notes.limit(0))
    load(store, "annotations", lambda: "v2", lambda: notes)
    return load(store, "annotations", lambda: "v2", lambda: notes.limit(0)).select("ann_id", "rid", "type", "note", "created")


def lookup_document(spark: SparkSession, d: str) -> DataFrame:
    """The lookup as one JSON document of dictionaries, a table of fixed size, read back as rows."""
    folder = _folder(spark)
    groups = table(spark, d, "lookup").groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("m"))
    groups.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("grp", "m")))).alias("value")).coalesce(1).write.text(folder)
    return documents.read_lookup(spark, folder)


def streamed_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries as JSON lines, taken in as a stream of files, with the key of the headword."""
    folder = _folder(spark)
    table(spark, d, "entries").drop("loaded_at", "seq", "part").repartition(3).write.json(f"{folder}/in")
    ingest.ingest(ingest.read_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out/entries").select("id", "hw", "norm", "p")


QUERIES = {f.__name__: f for f in (loaded_lines, malformed_lines, stored_snapshot, lookup_document, streamed_entries)}

ORACLE = {
    "loaded_lines": "SELECT row_number() OVER (ORDER BY part, seq) - 1 AS seq, part, id, hw, p, c, CAST(len(ah) AS INTEGER) AS others FROM entries",
    "malformed_lines": "SELECT 1 AS part, count(*) AS n FROM entries WHERE starts_with(c, '{') AND NOT contains(c, chr(10)) AND NOT json_valid(c)",
    "stored_snapshot": "SELECT ann_id, rid, type, note, created FROM annotations",
    "lookup_document": "SELECT grp, key, value FROM lookup",
    "streamed_entries": f"SELECT id, hw, translate(regexp_replace(coalesce(hw, ''), '[^א-ת]', '', 'g'), '{FINALS}', '{ORDINARY}') AS norm, p FROM entries",
}
