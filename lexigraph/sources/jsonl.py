"""JSON lines: parts read in the order listed, with dense ordinals in file order, and written back in parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: An entry; c and q are kept as JSON text, p as text because it comes as a number too.
ENTRY = "id string, hw string, p string, col string, ph string, nh string, g struct<l:string,ps:string,gn:string>, li string, c string, rf map<string,array<string>>, ah array<string>, pf array<string>, q string, mo string"


def read_lines(spark: SparkSession, paths: str | Sequence[str], schema: str = ENTRY, mode: str = "skip") -> tuple[DataFrame, DataFrame]:
    """The documents of one or more JSON lines files as ``seq, part, *fields``, and the malformed lines as ``part, line``.

    Parts count from 1 in the order given; blank lines are skipped; ``mode`` is ``skip`` or ``fail`` for malformed lines. A
    last line without an end counts. ``seq`` runs over the good lines of all parts without gaps.

    Each file split numbers its own good lines; a running sum over the splits (one row each) gives the first ordinal of a
    split. No task holds more than a split.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    lines = None
    for number, path in enumerate(files, 1):
        one = spark.read.text(path).select(F.lit(number).alias("part"), "value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
        lines = one if lines is None else lines.unionByName(one)
    lines = lines.where("trim(value) <> ''").withColumn("__at", F.monotonically_increasing_id())
    parsed = lines.withColumn("x", F.from_json("value", schema + ", __bad string", {"columnNameOfCorruptRecord": "__bad", "mode": "FAILFAST" if mode == "fail" else "PERMISSIVE"}))
    good = F.col("x").isNotNull() & F.col("x.__bad").isNull()
    # Places of the good lines within a split: the count of those before them, by the order of reading.
    split = ["part", "__file", "__block"]
    placed = parsed.where(good).withColumn("__row", F.row_number().over(Window.partitionBy(*split).orderBy("__at")))
    counts = placed.groupBy(*split).agg(F.count("*").alias("__n"))
    before = counts.withColumn("__first", F.sum("__n").over(Window.orderBy(*split)) - F.col("__n"))  # as many rows as splits
    rows = placed.join(before.drop("__n"), split)
    return rows.select((F.col("__first") + F.col("__row") - 1).cast("bigint").alias("seq"), "part", "x.*").drop("__bad"), parsed.where(~good).select("part", F.col("value").alias("line"))


def write_lines(df: DataFrame, path: str, parts: bool = True) -> None:
    """One document a line in file order, in a folder for each part; null fields are left out."""
    out = df.repartitionByRange("seq").sortWithinPartitions("seq") if "seq" in df.columns else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy("part") if parts and "part" in df.columns else writer).json(path)


def split_at(df: DataFrame, index: int) -> DataFrame:
    """Rows below ``index`` are part 1, the others part 2."""
    return df.withColumn("part", F.when(F.col("seq") < index, 1).otherwise(2))
