"""Links in HTML text as Column expressions: opening tags, attributes, anchors with their text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INSIDE = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""

#: An opening anchor tag; an anchor with its text, up to its end or the next anchor. Possessive, so long texts need no deep stack.
OPEN_TAG = rf"(?is)<a(?=[\s/>]){_INSIDE}>"
ANCHOR = rf"{OPEN_TAG}[^<]*+(?:<(?!/?a[\s>])[^<]*+)*+(?:</a\s*>)?"


def open_tags(html: Column) -> Column:
    """All opening anchor tags, as an array."""
    return F.regexp_extract_all(html, F.lit(OPEN_TAG), F.lit(0))


def anchors(html: Column) -> Column:
    """All anchors with their text, as an array; of nested anchors the outer one ends where the inner one begins."""
    return F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of the first tag in ``tag``, in either quotes or none; '' if there is none."""
    quoted = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""
    value = F.regexp_extract(tag, rf"(?is)^<\w+(?:\s+(?!{name}[\s=])[\w:.-]++(?:\s*+=\s*+{quoted})?+)*+\s+{name}\s*=\s*({quoted})", 1)
    return F.regexp_replace(value, r"""^["']|["']$""", "")


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", "")
