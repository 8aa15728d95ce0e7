"""Hash routes: parsed into a route and its argument by ordered rules, and built again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .validate import FIRST_PAGE, LAST_PAGE, page_number


def parse_route(hash_text: Column) -> Column:
    """``struct(route, arg)`` of an address hash without or with its ``#``; the first rule that holds wins.

    Routes: ``sages``, ``sage``, ``home`` (nothing, guide, abbreviations), ``word``, ``reference``, ``rid``, ``scan`` (a page in
    range; else ``none``), ``page``. Anything else is a word search. Null is ``home``.
    """
    h = F.coalesce(F.try_url_decode(F.replace(F.regexp_replace(F.coalesce(hash_text, F.lit("")), "^#", ""), F.lit("+"), F.lit("%2B"))), F.regexp_replace(hash_text, "^#", ""))
    after = lambda n: F.substring(h, n + 1, 1 << 30)
    spaced = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    scan = page_number(after(5), FIRST_PAGE, LAST_PAGE)
    route = (
        F.when(h == "sages", "sages").when(h.startswith("sage:"), "sage").when(h.isin("", "guide", "abbreviations"), "home")
        .when(h.startswith("word="), "word").when(h.startswith("ref:"), "reference").when(h.startswith("rid:"), "rid")
        .when(h.startswith("scan:"), F.when(scan.valid, "scan").otherwise("none"))
        .when(h.rlike("^[0-9]+$"), "page").otherwise("word")
    )
    arg = (
        F.when(h == "sages", None).when(h.startswith("sage:"), after(5)).when(h.isin("", "guide", "abbreviations"), F.nullif(h, F.lit("")))
        .when(h.startswith("word="), spaced(after(5))).when(h.startswith("ref:"), spaced(after(4))).when(h.startswith("rid:"), after(4))
        .when(h.startswith("scan:"), scan.page.cast("string")).otherwise(h)
    )
    return F.struct(route.alias("route"), arg.alias("arg"))


def build_route(page: Column, word: Column, ref: Column, rid: Column) -> Column:
    """The hash of the first of page, word, reference and rid that is not null; '' if all are."""
    return F.coalesce(
        F.concat(F.lit("#"), page.cast("string")), F.concat(F.lit("#"), word),
        F.concat(F.lit("#ref:"), F.replace(ref, F.lit(" "), F.lit("_"))), F.concat(F.lit("#rid:"), rid), F.lit(""),
    )


def rewrite_legacy_links(html: Column, book: str) -> Column:
    """Links to ``/<book>,_X`` become ``#word=X`` (X without a leading ``*`` and a trailing ``.N``); of these, ``target`` goes."""
    link = rf"""(<a\b[^>]*?)\shref="/{book},_\*?([^"]*?)(?:\.[0-9]+)?"([^>]*>)"""
    moved = F.regexp_replace(html, link, '$1 href="#word=$2"$3')
    return F.regexp_replace(F.regexp_replace(moved, r"""(<a\b[^>]*?)\starget="[^"]*"([^>]*href="#word=)""", "$1$2"), r"""(<a\b[^>]*href="#word=[^"]*"[^>]*?)\starget="[^"]*\"""", "$1")
