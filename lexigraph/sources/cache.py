"""A versioned snapshot store: data in a new folder each time, then a small marker that makes it current; gates on versions."""

from __future__ import annotations

import contextlib
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

UNKNOWN = "unknown"
#: Fixed value: how long the version check may take.
SECONDS = 2.0


class SnapshotStore:
    """Named tables under one folder on the cluster's storage. Writers replace a table by writing a new snapshot and then its
    marker, so readers see the old or the new one, whole; a lost writer leaves no marker."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def marker(self, name: str) -> dict | None:
        """``version, path`` of the current snapshot, or none."""
        try:
            rows = self.spark.read.schema("version string, path string, at long").json(f"{self.root}/{name}/markers").orderBy(F.desc("at"), F.desc("path")).limit(1).collect()
        except AnalysisException:
            return None
        return rows[0].asDict() if rows else None

    def write(self, name: str, df: DataFrame, version: str | None = None) -> str:
        """Make ``df`` the current snapshot; without ``version`` its version is the time of writing."""
        at = time.time_ns()
        version = version or time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(at // 10**9)) + f".{at % 10**9 // 10**6:03d}Z"
        path = f"{self.root}/{name}/data/{at}"
        df.write.parquet(path)
        self.spark.createDataFrame([(version, path, at)], "version string, path string, at long").coalesce(1).write.mode("append").json(f"{self.root}/{name}/markers")
        return version

    def read(self, name: str) -> DataFrame | None:
        """The current snapshot, or none; a snapshot that cannot be read counts as none."""
        mark = self.marker(name)
        try:
            return self.spark.read.parquet(mark["path"]) if mark else None
        except AnalysisException:
            return None

    def clear(self, name: str, like: DataFrame) -> None:
        """Make an empty snapshot current."""
        self.write(name, like.limit(0))


def needs_refresh(cached: str | None, served: str | None) -> bool:
    """Whether to fetch anew: the versions differ, or there is nothing cached. A server that cannot be reached (none) leaves
    what is cached in use."""
    return cached is None or (served is not None and served != cached)


def asked(served: Callable[[], str], seconds: float) -> str | None:
    """What ``served`` gives within a time, or none if it fails or takes longer."""
    answer: list[str] = []

    def ask() -> None:
        with contextlib.suppress(Exception):  # unreachable
            answer.append(served())

    thread = threading.Thread(target=ask, daemon=True)
    thread.start()
    thread.join(seconds)
    return answer[0] if answer else None


def load(store: SnapshotStore, name: str, served: Callable[[], str], fetch: Callable[[], DataFrame], seconds: float = SECONDS) -> DataFrame:
    """The table from the store or, if its version is out of date, fetched and stored. ``served`` may fail or give no answer
    within ``seconds``: then the cached table is used, or else fetched with the version ``unknown``. The old snapshot stays
    current until the new one is whole."""
    version = asked(served, seconds)
    mark = store.marker(name)
    if not needs_refresh(mark and mark["version"], version):
        held = store.read(name)
        if held is not None:
            return held
    store.write(name, fetch(), version or UNKNOWN)
    return store.read(name)
