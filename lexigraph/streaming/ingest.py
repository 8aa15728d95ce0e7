"""Lines as a stream: parsed as they arrive, derived tables appended batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.normalize import normalize_hebrew, normalize_reference
from ..sources.jsonl import ENTRY


def read_stream(spark: SparkSession, folder: str, schema: str = ENTRY, files_per_batch: int = 1) -> DataFrame:
    """The good lines of the files in a folder, as they arrive, with the key of the headword."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder).where("trim(value) <> ''")
    parsed = lines.select(F.from_json("value", schema + ", __bad string", {"columnNameOfCorruptRecord": "__bad"}).alias("x"))
    return parsed.where("x is not null and x.__bad is null").select("x.*").drop("__bad").withColumn("norm", normalize_hebrew(F.col("hw")))


def ingest(stream: DataFrame, out: str, checkpoint: str, more: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Append every batch to ``entries`` and its references to ``entry_refs`` under ``out``, one folder a batch: a batch that
    is run again after a failure overwrites its own folder, so each line is stored once. Stops when the folder is read."""

    def store(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        batch.write.mode("overwrite").parquet(f"{out}/entries/batch={number}")
        refs = batch.select("id", F.explode("rf").alias("category", "refs")).select("id", "category", F.explode("refs").alias("ref"))
        refs.withColumn("norm", normalize_reference(F.col("ref"))).write.mode("overwrite").parquet(f"{out}/entry_refs/batch={number}")
        if more:
            more(batch, number)
        batch.unpersist()

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Progress(StreamingQueryListener):
    """Calls back with (rows so far, rows a second) after each batch."""

    def __init__(self, tell: Callable[[int, float], None]):
        self.tell, self.rows = tell, 0

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        self.rows += event.progress.numInputRows
        self.tell(self.rows, event.progress.processedRowsPerSecond)

    def onQueryTerminated(self, event) -> None: ...
