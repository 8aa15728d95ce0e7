"""Validators of user input as Column functions; each gives a struct or a boolean, never an exception."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import JS_WS

#: Longest query and the printed pages.
MAX_QUERY, FIRST_PAGE, LAST_PAGE = 100, 1, 1704


def clean_query(query: Column, max_length: int = MAX_QUERY) -> Column:
    """``struct(valid, query, error)``: trimmed, not empty, not too long, without tags. Null is an empty query; the length
    is counted in code points."""
    trimmed = F.regexp_replace(F.coalesce(query, F.lit("")), f"^[{JS_WS}]+|[{JS_WS}]+$", "")
    clean = F.regexp_replace(trimmed, "<[^>]*>", "")
    error = (
        F.when(trimmed == "", "Empty query")
        .when(F.length(trimmed) > max_length, f"Query too long (max {max_length} characters)")
        .when(clean == "", "Invalid query content")
    )
    return F.struct(error.isNull().alias("valid"), F.when(error.isNull(), clean).alias("query"), error.alias("error"))


def allowed_url(url: Column, *domains: str) -> Column:
    """True for ``#`` addresses and for http(s) addresses of one of the domains or below; false for null and anything else."""
    parts = F.regexp_extract(url, r"(?i)^(https?)://(?:[^/?#@]*@)?([^/?#:@]+)(?::\d+)?(?:[/?#].*)?$", 2)
    host = F.lower(parts)
    below = F.lit(False)
    for d in domains:
        below = below | (host == d) | host.endswith("." + d)
    return F.coalesce(url.startswith("#") | below, F.lit(False))


def page_number(text: Column, first: int = FIRST_PAGE, last: int = LAST_PAGE) -> Column:
    """``struct(valid, page, error)``: the leading integer of a text, within a range. ``12abc`` is 12; null and texts without
    a leading integer are no numbers."""
    digits = F.regexp_extract(F.coalesce(text, F.lit("")), rf"^[{JS_WS}]*([+-]?[0-9]+)", 1)
    page = digits.try_cast("decimal(38,0)")
    error = F.when(page.isNull(), "Invalid page number").when((page < first) | (page > last), f"Page number must be between {first} and {last}")
    return F.struct(error.isNull().alias("valid"), F.when(error.isNull(), page.cast("bigint")).alias("page"), error.alias("error"))
