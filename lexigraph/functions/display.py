"""Display values as Column functions: dates, labels, badges, image names, curves, viewports, prompts, notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Badge and tooltip of the codes of languages, parts of speech and genders.
LANGUAGES = {"bh": ("Heb.", "Biblical Hebrew"), "he": ("Heb.", "Hebrew"), "ar": ("Aram.", "Aramaic"), "ar+he": ("Aram.+Heb.", "Aramaic + Hebrew"), "ar+bh": ("Aram.+BH", "Aramaic + Biblical Hebrew"), "he+ar": ("Heb.+Aram.", "Hebrew + Aramaic"), "ab": ("Arabic", "Arabic")}
SPEECH = {"n": ("Noun", "Noun"), "v": ("Verb", "Verb"), "a": ("Adj.", "Adjective"), "av": ("Adv.", "Adverb"), "pt": ("Part.", "Participle"), "ij": ("Interj.", "Interjection"), "cj": ("Conj.", "Conjunction")}
GENDERS = {"m": ("m", "Masculine"), "f": ("f", "Feminine")}

#: Pages of the scan before the first printed page.
SCAN_OFFSET = 15


def year(y: Column) -> Column:
    return F.when(y < 0, F.concat(F.abs(y).cast("string"), F.lit(" BCE"))).otherwise(F.concat(y.cast("string"), F.lit(" CE")))


def format_dates(born: Column, died: Column, approximate: Column) -> Column:
    """``~12 BCE – ~70 CE``; a missing year is left out; '' if both are missing."""
    mark = F.when(F.coalesce(approximate, F.lit(False)), "~").otherwise("")
    side = lambda y: F.when(y.isNull(), "").otherwise(F.concat(mark, year(y)))
    return F.when(born.isNull() & died.isNull(), "").otherwise(F.concat(side(born), F.lit(" – "), side(died)))


def badge(code: Column, table: dict[str, tuple[str, str]]) -> Column:
    """``struct(label, tooltip)`` of a code; null for unknown codes."""
    out = F.lit(None)
    for key, (label, tooltip) in table.items():
        out = F.when(code == key, F.struct(F.lit(label).alias("label"), F.lit(tooltip).alias("tooltip"))).otherwise(out)
    return out


def scan_name(page: Column) -> Column:
    """The number of the scan of a printed page, with at least four digits."""
    n = (page + SCAN_OFFSET).cast("string")
    return F.lpad(n, F.greatest(F.length(n), F.lit(4)), F.lit("0"))


def sense_number(n: Column) -> Column:
    """The number of a sense without its leading dash."""
    return F.regexp_replace(n, r"^[—-]\s*", "")


def short_label(text: Column, longest: int = 20) -> Column:
    """At most ``longest`` code points, then an ellipsis."""
    return F.when(F.length(text) > longest, F.concat(F.left(text, F.lit(longest)), F.lit("…"))).otherwise(text)


def counted(n: Column, noun: str = "result") -> Column:
    """``1 result``, ``2 results``."""
    return F.concat(n.cast("string"), F.lit(f" {noun}"), F.when(n == 1, "").otherwise("s"))


def curve(x1: Column, y1: Column, x2: Column, y2: Column, width: float = 140, height: float = 44) -> Column:
    """``struct(sx, sy, mx, my, tx, ty)``: a quadratic curve between the centres of two nodes, its middle moved aside by a
    tenth of their vertical distance."""
    sx, sy, tx, ty = x1 + width / 2, y1 + height / 2, x2 + width / 2, y2 + height / 2
    return F.struct(sx.alias("sx"), sy.alias("sy"), ((sx + tx) / 2 + (ty - sy) * 0.1).alias("mx"), ((sy + ty) / 2).alias("my"), tx.alias("tx"), ty.alias("ty"))


def fit_view(view_w: Column, view_h: Column, width: Column, height: Column) -> Column:
    """``struct(scale, tx, ty)`` that fits a drawing into a view, centred, at nine tenths of at most its own size."""
    scale = F.least(view_w / width, view_h / height, F.lit(1.0)) * 0.9
    return F.struct(scale.alias("scale"), ((view_w - width * scale) / 2).alias("tx"), ((view_h - height * scale) / 2).alias("ty"))


def zoomed(scale: Column, steps: Column, factor: float = 1.3) -> Column:
    """The scale after zooming in (positive) or out by steps."""
    return scale * F.pow(F.lit(factor), steps)


def progress(done_files: Column, fraction: Column, files: Column) -> Column:
    """Percent loaded, at most 100."""
    return F.least((done_files + fraction) / files * 100, F.lit(100.0))


def search_text(*parts: Column) -> Column:
    """The parts joined by spaces in lower case; null parts are empty."""
    return F.lower(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts)))


def prompt_line(rid: Column, hw: Column, language: Column, definition: Column, longest: int = 200) -> Column:
    """One entry as a line for a classifier."""
    or_ = lambda c, other: F.coalesce(F.nullif(c, F.lit("")), F.lit(other))
    return F.concat(F.lit("RID: "), or_(rid, ""), F.lit(" | Headword: "), or_(hw, ""), F.lit(" | Language: "), or_(language, "?"), F.lit(" | Definition: "), F.left(or_(definition, ""), F.lit(longest)))


def json_in_text(text: Column, kind: str = "array") -> Column:
    """The greedy ``[...]`` or ``{...}`` in a text; '' if there is none."""
    return F.regexp_extract(text, r"(?s)\[.*\]" if kind == "array" else r"(?s)\{.*\}", 0)


def suggestion(ps: Column, gn: Column) -> Column:
    """The note of a suggested classification; a missing gender, or the word ``null``, is left out."""
    return F.concat(F.lit("AI suggests: ps="), ps, F.when(F.coalesce(gn, F.lit("")).isin("", "null"), "").otherwise(F.concat(F.lit(", gn="), gn)))


def occurrences(text: Column, part: str) -> Column:
    """How often ``part`` occurs in a text, without overlaps; 0 for null."""
    return F.coalesce(((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("bigint"), F.lit(0).cast("bigint"))
