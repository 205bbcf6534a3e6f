"""Text expressions: trimming, normal form, markup and escapes.  All are JVM-side columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the punctuation that a normal form drops.
PUNCTUATION = ".,;:!?'\"-()[]{}"
#: Combining marks that a normal form drops; the tilde (U+0303) stays after N.
MARKS = "\u0300-\u036f"
TILDE = "\u0303"


def _without_marks(c: str) -> str:
    kept = [x for x in unicodedata.normalize("NFD", c) if not "\u0300" <= x <= "\u036f"]
    return unicodedata.normalize("NFC", "".join(kept))


def _plain_letters() -> dict[str, str]:
    """Letters that canonical decomposition changes once their marks are gone, but for Ñ and ñ: one letter for one."""
    every = (chr(c) for c in range(0xC0, 0x10000) if not 0xD800 <= c < 0xE000)
    pairs = ((c, _without_marks(c)) for c in every if unicodedata.decomposition(c) and c not in "Ññ")
    return {c: plain for c, plain in pairs if plain != c and len(plain) == 1}


PLAIN = _plain_letters()
ACCENTED, PLAINED = "".join(PLAIN), "".join(PLAIN.values())


def trim_u(text: Column) -> Column:
    """Without white space of any kind at both ends; Spark's trim takes blanks only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(trim_u(text), F.lit(""))


def blank_to_empty(text: Column) -> Column:
    return F.coalesce(trim_u(text), F.lit(""))


def keep_unless_blank(text: Column) -> Column:
    """The text as it is, or null if it has nothing but white space."""
    return F.when(trim_u(text) != "", text)


def fold_accents(text: Column) -> Column:
    """Letters without accents; N with tilde stays.  Letters of any script that have one plain letter."""
    return F.translate(text, ACCENTED, PLAINED)


def normalize_text(text: Column, *, preserve_case: bool = False, remove_punctuation: bool = True, collapse_whitespace: bool = True) -> Column:
    """Normal form of a name: trimmed, upper case, without accents (Ñ stays), single blanks, no punctuation.

    Accents go whether a letter holds them or combining marks follow it.  Blanks
    are joined before punctuation goes, so "A - B" keeps two.  With preserve_case
    a small ñ loses its tilde.  All in the JVM; letters that other marks compose
    (Hangul parts, voiced kana) stay as they are written: normalize_text_exact()
    composes them.
    """
    x = trim_u(text)
    x = x if preserve_case else F.upper(x)
    x = F.regexp_replace(x, "N" + TILDE, "Ñ")
    x = F.regexp_replace(fold_accents(x), f"[{MARKS}]++", "")
    if preserve_case:
        x = F.translate(x, "ñ", "n")
    if collapse_whitespace:
        x = trim_u(F.regexp_replace(x, r"(?U)\s+", " "))
    return F.translate(x, PUNCTUATION, "") if remove_punctuation else x


def normal_form(text: str, *, preserve_case: bool = False, remove_punctuation: bool = True, collapse_whitespace: bool = True) -> str:
    """The same for any script, by canonical decomposition."""
    x = text.strip()
    x = x if preserve_case else x.upper()
    marks = unicodedata.normalize("NFD", x)
    x = "".join(c for before, c in zip(" " + marks, marks, strict=False) if not "\u0300" <= c <= "\u036f" or (c == TILDE and before == "N"))
    x = unicodedata.normalize("NFC", x)
    if collapse_whitespace:
        x = " ".join(x.split())
    return x.translate(str.maketrans("", "", PUNCTUATION)) if remove_punctuation else x


@F.pandas_udf(StringType())
def normalize_text_exact(text: pd.Series) -> pd.Series:
    """normal_form() of a column: for scripts beyond Latin; distinct values are worked out once a batch."""
    known = {x: normal_form(x) for x in text.dropna().unique()}
    return text.map(known)


def br_to_newline(text: Column) -> Column:
    """Every spelling of <br> as a line break; empty becomes null."""
    return F.nullif(F.regexp_replace(text, r"(?i)<\s*br\s*/?\s*>", "\n"), F.lit(""))


def unescape_sql(text: Column) -> Column:
    r"""\' \\ \n \r of a dump's literals; other escapes keep their backslash.  One pass from left to right."""
    # The escapes and what they say.
    said = {"\\'": "'", "\\\\": "\\", "\\n": "\n", "\\r": "\r"}
    names = F.create_map(*[F.lit(x) for pair in said.items() for x in pair])
    parts = F.regexp_extract_all(text, F.lit(r"(?s)\\.|[^\\]++|\\"), F.lit(0))
    plain = F.array_join(F.transform(parts, lambda p: F.coalesce(F.element_at(names, p), p)), "")
    return F.when(F.contains(text, F.lit("\\")), plain).otherwise(text)
