"""Pages and windows over file order: ranges of the dense ordinal, so that a page is a pruned range read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a chunk, and rows that stay resident.
CHUNK, RESIDENT = 50, 250


def on_page(entries: DataFrame, page: int) -> DataFrame:
    """The rows of a printed page, in file order."""
    return entries.where(F.col("page") == page).orderBy("seq")


def page_start(entries: DataFrame, page: int) -> DataFrame:
    """One row: the first ordinal of a page, or -1."""
    return entries.where(F.col("page") == page).agg(F.coalesce(F.min("seq"), F.lit(-1)).alias("start"))


def rows_range(entries: DataFrame, start: int, count: int) -> DataFrame:
    """``count`` rows from ordinal ``start``; a negative start is 0, what lies beyond the end is left out."""
    low = max(start, 0)
    return entries.where(F.col("seq").between(low, low + max(count, 0) - 1)).orderBy("seq")


def initial_window(entries: DataFrame, page: int, ordinal: int = -1, count: int = CHUNK) -> DataFrame:
    """The first chunk: from the ordinal if there is one, else from the start of the page; nothing for a missing page."""
    if ordinal >= 0:
        return rows_range(entries, ordinal, count)
    start = page_start(entries, page).first()["start"]  # one number, so that the range reaches the scan
    return rows_range(entries, start, count if start >= 0 else 0)


def forward(end: int, total: int, count: int = CHUNK) -> tuple[int, int]:
    """The next chunk after ``end`` (exclusive), clipped, as (start, count)."""
    return end, max(min(count, total - end), 0)


def backward(start: int, count: int = CHUNK) -> tuple[int, int]:
    """The chunk before ``start``, clipped, as (start, count)."""
    low = max(start - count, 0)
    return low, start - low


def resident(start: int, end: int, grown: str, most: int = RESIDENT) -> tuple[int, int]:
    """The resident range after growth at one end: the far end is evicted beyond ``most`` rows."""
    if end - start <= most:
        return start, end
    return (end - most, end) if grown == "forward" else (start, start + most)
