"""Texts that look alike brought to one form: compatibility forms, combining marks, invisible characters, blanks, look-alikes.

Pairs are found from the distinct spellings, whose form is computed once each: spellings of one form are paired with each
other first, then each spelling with its rows, so that repeated rows of one spelling are never compared with each other. A
column of forms alone (``look_form``) is computed row by row without a shuffle, once for each distinct value of an Arrow batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of default-ignorable code points, which print nothing.
IGNORABLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF)]

#: Letters and signs that look the same, after decomposition: Cyrillic and Greek as Latin, quotes as Hebrew
#: punctuation, Hebrew digraphs as letters, the small qamats as the qamats.
ALIKE = dict(zip("АВСЕНІЈКМОРЅТХѴԌԚԜаеіјорсухѕѵԁԛԝҮһ", "ABCEHIJKMOPSTXVGQWaeijopcyxsvdqwYh")) | dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳ", "ABEZHIKMNOPTYXocj")) | dict(zip("\"”″'’′", "״״״׳׳׳")) | {"װ": "וו", "ױ": "וי", "ײ": "יי", "ׇ": "ָ"}

#: Kinds of compatibility decomposition after which a character looks otherwise than before.
_OTHERWISE = {"<super>", "<sub>", "<circle>", "<square>", "<fraction>", "<vertical>", "<small>"}


class _Marks(dict):
    """For str.translate: what each character becomes before decomposition."""

    def __missing__(self, code: int):
        c = chr(code)
        if any(a <= code <= b for a, b in IGNORABLE):
            new = None
        elif c in ALIKE:
            new = ALIKE[c]
        elif c.isspace():
            new = " "
        elif unicodedata.category(c) == "Cc":
            new = None
        else:
            kind = unicodedata.decomposition(c).split(" ")[0]
            new = unicodedata.normalize("NFKD", c) if kind.startswith("<") and kind not in _OTHERWISE else c
            if new[:1] == " " or not new:  # a spacing accent
                new = c
        self[code] = new
        return new


_MARKS, _ALIKE = _Marks(), str.maketrans(ALIKE)


def look(text: str | None, fold_case: bool = False) -> str | None:
    """The one form of all texts that look like ``text``; null stays null. ``fold_case`` also levels upper and lower case."""
    if text is None:
        return None
    text = unicodedata.normalize("NFD", text.translate(_MARKS)).translate(_ALIKE)
    if fold_case:
        text = unicodedata.normalize("NFD", text.casefold())
    return unicodedata.normalize("NFC", text).strip(" ")


def look_form(c: Column, fold_case: bool = False, once: bool = False) -> Column:
    """``look`` of a column, computed once for each distinct value of a batch; ``once`` keeps the optimiser from moving or
    repeating it.

    Null stays null; texts that print nothing become ''; idempotent; texts of any length are taken whole.
    """

    @F.pandas_udf("string")
    def forms(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            codes, values = pd.factorize(s)
            made = pd.Series([look(v, fold_case) for v in values], dtype=object)
            yield pd.Series([None if k < 0 else made[k] for k in codes], dtype=object)

    return (forms.asNondeterministic() if once else forms)(c)


def look_alikes(df: DataFrame, text_col: str, id_col: str, fold_case: bool = False) -> DataFrame:
    """All pairs ``id_a < id_b`` of rows whose texts look the same without being the same string.

    Null texts and texts that print nothing are in no pair; rows of one spelling are in no pair with each other; an id on
    several rows counts for each. The work follows the number of pairs returned, not the square of a group.
    """
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where("__text <> ''")
    # The form is marked as not deterministic, so that no filter on it is moved below the distinct spellings.
    spelt = rows.select("__text").distinct().select("__text", look_form(F.col("__text"), fold_case, once=True).alias("__look")).where("__look <> ''")
    of_look = Window.partitionBy("__look")
    spelt = spelt.withColumn("__least", F.min("__text").over(of_look)).withColumn("__most", F.max("__text").over(of_look)).where("__least < __most").select("__look", "__text")
    other = spelt.select("__look", F.col("__text").alias("__other"))
    pairs = spelt.join(other, "__look").where("__text < __other").select("__text", "__other")
    left = rows.join(pairs, "__text").select(F.col("__id").alias("__a"), F.col("__other"))
    both = left.join(rows.select(F.col("__id").alias("__b"), F.col("__text").alias("__other")), "__other")
    return both.select(F.least("__a", "__b").alias(f"{id_col}_a"), F.greatest("__a", "__b").alias(f"{id_col}_b"))
