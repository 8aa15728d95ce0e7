"""Session helpers: a tuned local session, table reading, and lineage cuts in the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "lexigraph", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster, pass the cluster's own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table (a file or a folder of files) of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for data that all machines must see: the session's ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests) gets a temporary folder, removed at the end; on a cluster it is an error, as
    a folder of one machine would lose the data.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder")
            folder = tempfile.mkdtemp(prefix="lexigraph-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that it is computed once and survives lost executors. The job runs
    while the plan is under construction."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores before heavy work on each row: a plain scan of fewer than half as many splits as there are cores
    (one small file of one row group) is dealt out; anything else stays as it is, so large inputs are not shuffled. Only the
    plan depends on this, never the rows."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":  # it holds a shuffle already
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < plan.execute().getNumPartitions() * 2 < cores else df


def bounded(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` is proven to hold at most ``max_rows`` rows; reads no more than that many plus one."""
    return df.limit(max_rows + 1).count() <= max_rows


def tokenizer_dir() -> str:
    """Where the public tokenizer files lie (``LEXIGRAPH_TOKENIZERS`` or /opt/tokenizers)."""
    return os.environ.get("LEXIGRAPH_TOKENIZERS", "/opt/tokenizers")
