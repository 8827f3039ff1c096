"""Cleaning and token expressions over a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. They mean the same in Java and RE2 regular expressions, so a
# SQL engine can check the results.
INVISIBLE = r"[\p{Cf}\p{Co}]+"
BLANK = r"[\p{Cc}\p{Z}]+"
WORD = r"[\p{L}\p{N}]+"
WORD_OR_OTHER = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]"
EDGE_BLANKS = r"^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$"


def clean(text: Column) -> Column:
    """Drop invisible and private-use characters, make every run of blanks one space."""
    visible = F.regexp_replace(text, INVISIBLE, "")
    return F.trim(F.regexp_replace(visible, BLANK, " "))


def strip(text: Column) -> Column:
    """Remove Unicode blanks at both ends, as a web form field does."""
    return F.regexp_replace(text, EDGE_BLANKS, "")


def words(text: Column) -> Column:
    """Runs of letters and digits; everything else is dropped."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def all_pieces(text: Column) -> Column:
    """Runs of letters and digits, and every other character as its own token."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_OTHER), F.lit(0))


# Scripts written without blanks between words. Fixed Unicode script names.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"


def mixed(text: Column, n: int = 2) -> Column:
    """All pieces, but runs of scripts without blanks as character n-grams.

    Texts without such a script take the plain way.
    """
    pattern = rf"[{UNSPACED}]+|[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+|[^\p{{L}}\p{{N}}]"
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    unspaced = F.flatten(
        F.transform(
            parts,
            lambda part: F.when(
                part.rlike(f"^[{UNSPACED}]") & (F.char_length(part) >= n), char_ngrams(part, n)
            ).otherwise(F.array(part)),
        )
    )
    return F.when(text.rlike(f"[{UNSPACED}]"), unspaced).otherwise(all_pieces(text))


def char_ngrams(text: Column, n: int = 2) -> Column:
    """Overlapping runs of ``n`` characters, for scripts written without blanks.

    One pass: at each character look ahead for ``n``, then step over the one.
    (``substring`` at every position would walk the string from its start each
    time, quadratic in the text length.)
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))


def char_windows(text: Column, n: int) -> Column:
    """The ``n`` characters from each character on, fewer at the end of the text."""
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{1,{n}}}))."), F.lit(1))
