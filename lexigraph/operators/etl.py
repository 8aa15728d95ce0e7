"""Text and HTML stages: language and speech tags, links, abbreviations, categories, allow-list, key names, clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import occurrences
from ..functions.links import attribute, strip_tags
from .nested import rewrite_strings

#: Allowed tags; attributes allowed on some tags and on all.
TAGS = ("a", "abbr", "b", "br", "div", "em", "i", "p", "span", "strong", "sub", "sup")
ATTRIBUTES = {"a": ("href", "class", "target", "rel"), "abbr": ("title",), "span": ("dir", "class"), "div": ("class",)}
ANYWHERE = ("class", "dir")
#: Long and short key names of entries and senses.
SHORT_KEYS = {"headword": "hw", "rid": "id", "page": "p", "column": "col", "content": "c", "next_hw": "nh", "prev_hw": "ph", "grammar": "g", "language_info": "li", "references": "rf", "alt_headwords": "ah", "plural_form": "pf", "quotes": "q", "morphology": "mo", "senses": "s", "definition": "d", "number": "n", "verbal_stem": "vs", "binyan_form": "bf"}
#: Fields always dropped, and those dropped when empty.
DROPPED, DROPPED_EMPTY = ("_id", "parent_lexicon", "language_code", "language_reference"), ("q", "pf", "ah")


def language(code: Column) -> Column:
    """The language tag of an HTML language code, by the first rule that holds; null if none does."""
    t = F.regexp_replace(F.lower(strip_tags(F.coalesce(code, F.lit("")))), r"\s+", " ")
    has = lambda x: F.contains(t, F.lit(x))
    word = lambda x: t.rlike(rf"(^|[^a-z]){re.escape(x)}")
    ch = word("ch.")
    return (
        F.when(ch & has("= h."), "ar+he").when(ch & has("= b."), "ar+bh").when(has("h. a. ch.") | has("h. = ch."), "he+ar")
        .when(t.rlike(r"(^|[^a-z])ch\. = "), "ar").when(has("b. h."), "bh").when(ch, "ar").when(word("ar."), "ab").when(word("h."), "he")
    )


def speech(definition: Column, has_forms: Column) -> Column:
    """``struct(ps, gn)`` from the start of the first definition; an entry with stems or forms is a verb. Null if unknown."""
    t = F.trim(strip_tags(F.coalesce(definition, F.lit(""))))
    rules = [(r"pr\. n\. m\.", "n", "m"), (r"pr\. n\. f\.", "n", "f"), (r"m\. pl\.", "n", "m"), (r"f\. pl\.", "n", "f"), (r"interj\.", "ij", None), (r"part\.", "pt", None), (r"conj\.", "cj", None), (r"adj\.", "a", None), (r"adv\.", "av", None), (r"m\.", "n", "m"), (r"f\.", "n", "f"), (r"n\.", "n", None), (r"v\.", "v", None)]
    tag = lambda ps, gn: F.struct(F.lit(ps).alias("ps"), F.lit(gn).cast("string").alias("gn"))
    out = F.when(F.coalesce(has_forms, F.lit(False)), tag("v", None))
    for pattern, ps, gn in rules:
        out = out.when(t.rlike("^" + pattern), tag(ps, gn))
    return out


def rewrite_links(html: Column, book: str, site: str) -> Column:
    """Source links to cross-references within ``book`` become ``#WORD`` word links; others with a ``data-ref`` become links
    of class ref-link to ``site``."""
    inner = F.regexp_replace(html, rf'<a class="refLink" href="/{book},_([^"]*?)(?:\.[0-9]+)?"[^>]*>', '<a href="#$1" class="word-link">')
    return F.regexp_replace(inner, r'<a class="refLink" href="/[^"]*" data-ref="([^"]*)"[^>]*>', f'<a href="{site}/$1" target="_blank" rel="noopener noreferrer" class="ref-link">')


def data_refs(html: Column) -> Column:
    """The ``data-ref`` values of a text, as an array."""
    return F.regexp_extract_all(html, F.lit(r'data-ref="([^"]*)"'), F.lit(1))


def mark_abbreviations(html: Column, abbreviations: Sequence[str], shortest: int = 3) -> Column:
    """Known abbreviations in ``<abbr>``: longest first, between the start, white space, ``(`` or ``;`` and the end, white space
    or ``),;``; never within tags, links or other abbreviations."""
    known = sorted({a for a in abbreviations if len(a) >= shortest}, key=lambda a: (-len(a), a))
    if not known:
        return html
    wanted = rf"(^|[\s(;])({'|'.join(map(re.escape, known))})(?=$|[\s),;])"
    pieces = F.regexp_extract_all(html, F.lit(r"(?is)<a\b.*?</a\s*>|<abbr\b.*?</abbr\s*>|<[^>]+>|[^<]+|<"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda x: F.when(x.startswith("<"), x).otherwise(F.regexp_replace(x, wanted, "$1<abbr>$2</abbr>"))), "")


def categorise(refs: DataFrame, books: DataFrame, key: str = "seq", other: str = "o") -> DataFrame:
    """References by category: ``key, category, refs`` (distinct, sorted). The longest book name that is a whole beginning of
    a reference gives its category; without one it is ``other``. ``books``: ``book, category``.

    Every reference is met with the books by equality on its beginnings up to a space, not by comparing all books.
    """
    words = F.split("ref", " ")
    heads = refs.select(key, "ref").distinct().select(key, "ref", F.explode(F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.lower(F.array_join(F.slice(words, F.lit(1), n), " ")))).alias("__head"))
    named = books.select(F.lower("book").alias("__head"), "category").dropDuplicates(["__head"])
    met = heads.join(named, "__head", "left").groupBy(key, "ref").agg(F.max(F.when(F.col("category").isNotNull(), F.struct(F.length("__head").alias("n"), F.col("category")))).alias("x"))
    return met.groupBy(key, F.coalesce("x.category", F.lit(other)).alias("category")).agg(F.sort_array(F.collect_set("ref")).alias("refs"))


def strip_fields(df: DataFrame) -> DataFrame:
    """Without the fields always dropped; empty arrays of the fields dropped when empty are null."""
    out = df.drop(*DROPPED)
    for c in DROPPED_EMPTY:
        if c in out.columns and out.schema[c].dataType.typeName() == "array":
            out = out.withColumn(c, F.when(F.size(c) > 0, F.col(c)))
    return out


def markup_violations(html: DataFrame, key: str, text: str) -> DataFrame:
    """``key, rule, value, n``: tags and attributes off the allow-list and ``javascript:`` addresses; reported, not removed."""
    tags = html.select(key, F.explode(F.regexp_extract_all(text, F.lit(r"(?s)</?[a-zA-Z][^>]*>?"), F.lit(0))).alias("tag")).select(key, "tag", F.lower(F.regexp_extract("tag", r"^</?([a-zA-Z0-9]+)", 1)).alias("name"))
    names = F.transform(F.regexp_extract_all(F.regexp_replace("tag", r"""=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "="), F.lit(r"\s([a-zA-Z_:][a-zA-Z0-9_:.-]*)"), F.lit(1)), F.lower)
    allowed = F.array(*map(F.lit, ANYWHERE))
    for name, attributes in ATTRIBUTES.items():
        allowed = F.when(F.col("name") == name, F.array(*map(F.lit, sorted({*attributes, *ANYWHERE})))).otherwise(allowed)
    rule = lambda r, v: F.struct(F.lit(r).alias("rule"), v.alias("value"))
    found = F.concat(
        F.when(F.col("name").isin(*TAGS), F.array()).otherwise(F.array(rule("tag", F.col("name")))),
        F.transform(F.array_except(names, allowed), lambda a: rule("attribute", F.concat(F.col("name"), F.lit("."), a))),
        F.when(F.lower(F.trim(attribute(F.col("tag"), "href"))).startswith("javascript:"), F.array(rule("address", attribute(F.col("tag"), "href")))).otherwise(F.array()),
    )
    return tags.select(key, F.explode(found).alias("x")).groupBy(key, "x.rule", "x.value").agg(F.count("*").alias("n"))


def shorten_keys(json_text: Column) -> Column:
    """Long key names in a JSON text shortened at every depth. Only keys are met: a quote within a string is escaped."""
    any_ = rf'"(?:{"|".join(SHORT_KEYS)})"\s*:'  # texts without a long name are left at once
    out = json_text
    for long, short in SHORT_KEYS.items():
        out = F.regexp_replace(out, rf'(?<=[{{,\s])"{long}"(?=\s*:)', f'"{short}"')
    return F.when(json_text.rlike(any_), out).otherwise(json_text)


def resolve_word_links(links: DataFrame, entries: DataFrame, target: str = "target") -> DataFrame:
    """``links`` with ``id``: the first entry whose headword is the target, as it is written; null if there is none."""
    ids = entries.where("hw is not null and id is not null").groupBy(F.col("hw").alias("__hw")).agg(F.min_by("id", "seq").alias("id"))
    return links.join(ids, F.col(target) == F.col("__hw"), "left").drop("__hw")


def strip_titles(html: Column) -> Column:
    """Abbreviations without their titles."""
    return F.regexp_replace(html, r"""(?is)(<abbr\b[^>]*?)\stitle=(?:"[^"]*"|'[^']*')""", "$1")


def _source_link(book: str) -> str:
    """A source link to a cross-reference within ``book``, for the regular expressions of Java and of Python."""
    return rf'(?s)<a\b[^>]*class="refLink"[^>]*href="/{re.escape(book)},_[^"]*"[^>]*>(.*?)</a>'


def strip_nested_links(html: Column, book: str) -> Column:
    """HTML without the source links to cross-references within ``book``, whose text stays; links to other works stay too."""
    return F.regexp_replace(html, _source_link(book), "$1")


def patch(text: Column, key: Column, value: str, old: str, new: str) -> Column:
    """A literal replacement in the row of one key."""
    return F.when(key == value, F.replace(text, F.lit(old), F.lit(new))).otherwise(text)


def clean_nested_links(entries: DataFrame, column: str, book: str) -> tuple[DataFrame, DataFrame]:
    """The entries with the strings of their JSON ``column`` cleaned as ``strip_nested_links`` does, at any depth and also in JSON
    that is a string; and what changed by ``part`` and in total (null): ``entries_changed, links_fixed, remaining``, which is
    0 unless a text is unreadable or a link has no end."""
    link, mark = re.compile(_source_link(book)), f"/{book},_"
    kept = entries.select("part", F.col(column).alias("__old"), F.col(column).alias("__new"))
    report = rewrite_strings(kept, "__new", lambda text: link.sub(r"\1", text), mark)
    before, after = occurrences(F.col("__old"), mark), occurrences(F.col("__new"), mark)
    report = report.select("part", (before - after).alias("fixed"), after.alias("left")).rollup("part").agg(F.count_if(F.col("fixed") > 0).alias("entries_changed"), F.sum("fixed").alias("links_fixed"), F.sum("left").alias("remaining"))
    return rewrite_strings(entries, column, lambda text: link.sub(r"\1", text), mark), report
