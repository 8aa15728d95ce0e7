"""JSON documents: abbreviation maps, abbreviation lists, graphs, lookup dictionaries; read whole, flattened, written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """The text of a file as one row."""
    return spark.read.text(path, wholetext=True)


def read_abbreviations(spark: SparkSession, path: str) -> DataFrame:
    """``key, original, modern``. A document without an ``abbreviations`` object fails when it is read."""
    doc = _whole(spark, path).select(F.from_json("value", "abbreviations map<string, struct<original:string, modern:string>>").alias("x"))
    held = F.when(F.col("x.abbreviations").isNull(), F.raise_error(F.lit("no abbreviations object in the document"))).otherwise(F.col("x.abbreviations"))
    return doc.select(F.explode(held).alias("key", "v")).select("key", "v.original", "v.modern")


def read_abbreviation_lines(spark: SparkSession, path: str, skip: int = 2) -> DataFrame:
    """``pos, html``: the lines of the first version, without the first ``skip``."""
    doc = _whole(spark, path).select(F.from_json("value", "versions array<struct<text:array<string>>>").alias("x"))
    return doc.select(F.posexplode("x.versions").alias("v", "t")).where("v = 0").select(F.posexplode("t.text").alias("pos", "html")).where(F.col("pos") >= skip)


def read_graph(spark: SparkSession, path: str, sage: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Sages with their position ``pos``, and landmarks ``year, label``."""
    kind = sage if isinstance(sage, str) else sage.simpleString()
    doc = _whole(spark, path).select(F.from_json("value", f"sages array<{kind}>, landmarks array<struct<year:int,label:string>>").alias("x"))
    return doc.select(F.posexplode("x.sages").alias("pos", "s")).select(F.col("pos").cast("bigint").alias("pos"), "s.*"), doc.select(F.explode("x.landmarks").alias("l")).select("l.*")


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """``grp, key, value`` of a dictionary of dictionaries."""
    doc = _whole(spark, path).select(F.from_json("value", "map<string, map<string, string>>").alias("x"))
    return doc.select(F.explode("x").alias("grp", "m")).select("grp", F.explode("m").alias("key", "value"))


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """``rid, type, note, created``; a missing or unreadable document is an empty one."""
    schema = "map<string, array<struct<type:string, note:string, created:date>>>"
    try:
        doc = _whole(spark, path)
    except AnalysisException:
        doc = spark.createDataFrame([], "value string")
    return doc.select(F.explode(F.from_json("value", schema)).alias("rid", "a")).select("rid", F.explode("a").alias("x")).select("rid", "x.*")


def write_document(df: DataFrame, path: str, root: str | None = None) -> None:
    """All rows as one indented JSON document, an array or an object with it under ``root``; for small tables."""
    rows = F.collect_list(F.struct(*df.columns))
    doc = df.agg(F.to_json(F.struct(rows.alias(root)) if root else rows, {"pretty": "true", "ignoreNullFields": "true"}).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)
