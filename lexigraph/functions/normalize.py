"""Normalisation of headwords, references, codes and ids as Column expressions; all stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, as a Java and RE2 character class (with the byte order mark and the zero-width space).
WS = r"\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"

#: The white space of a script's ``\\s`` and ``trim``, which reference strings and queries are read by.
JS_WS = r"\t\n\x{000B}\x{000C}\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"

#: Final Hebrew letters and their ordinary ones.
FINALS, ORDINARY = "ךםןףץ", "כמנפצ"


def _letter_forms() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters that stand for Hebrew letters by their compatibility decomposition: one letter each, then several."""
    one, many = {}, []
    for code in [*range(0x2135, 0x2139), *range(0xFB1D, 0xFB50)]:
        letters = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if "א" <= x <= "ת")
        if len(letters) == 1:
            one[chr(code)] = letters
        elif letters:
            many.append((chr(code), letters))
    for code, letters in ((0x5F0, "וו"), (0x5F1, "וי"), (0x5F2, "יי"), (0xFB1F, "יי")):
        many.append((chr(code), letters))
    return "".join(one), "".join(one.values()), many


FORMS_OF, LETTERS_OF, SEVERAL = _letter_forms()


def trim_all(c: Column) -> Column:
    """Without white space of any kind at the ends; null stays null."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def fold_finals(c: Column) -> Column:
    return F.translate(c, FINALS, ORDINARY)


def normalize_hebrew(c: Column) -> Column:
    """Only the plain Hebrew letters, final letters as ordinary ones; null gives ''."""
    return fold_finals(F.regexp_replace(F.coalesce(c, F.lit("")), "[^א-ת]", ""))


def hebrew_letters(c: Column) -> Column:
    """As ``normalize_hebrew``, after presentation forms, letter-like symbols and ligatures became plain letters."""
    c = F.translate(F.coalesce(c, F.lit("")), FORMS_OF, LETTERS_OF)
    for mark, letters in SEVERAL:
        c = F.replace(c, F.lit(mark), F.lit(letters))
    return fold_finals(F.regexp_replace(c, "[^א-ת]", ""))


def normalize_reference(c: Column) -> Column:
    """Lower case, no full stops, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("."), F.lit("")), f"[{JS_WS}]+", " "))


def read_code(c: Column, *known: str) -> Column:
    """A code without regard to case, surrounding blanks and one final dot; null unless among ``known``."""
    code = F.regexp_replace(F.lower(trim_all(c)), f"[{WS}]*\\.$", "")
    return F.when(code.isin(*known), code)


def entry_id(c: Column) -> Column:
    """An entry id in its written form (upper case); blank ids are null."""
    return F.nullif(F.upper(trim_all(c)), F.lit(""))


def sage_id(c: Column) -> Column:
    """A sage id in its written form (lower case); blank ids are null."""
    return F.nullif(F.lower(trim_all(c)), F.lit(""))
