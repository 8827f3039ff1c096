"""Hashes that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textjury.functions.arrays import bind
from textjury.functions.text import char_ngrams

# Marks before the first and after the last character, so that beginnings and ends are n-grams of their own.
BEGIN, END = "\x02", "\x03"


def md5_bucket(value: Column, buckets: int) -> Column:
    """First 32 bits of the md5 of a string, modulo ``buckets``."""
    head = F.conv(F.substring(F.md5(value), 1, 8), 16, 10)
    return (head.cast("bigint") % F.lit(buckets).cast("bigint")).cast("int")


def similar_signature(word: Column, rows: int = 2, n: int = 2) -> Column:
    """A locality-sensitive signature: words that share most character n-grams often have the same one.

    Row r keeps the least md5 over the word's n-grams; two words agree in a row with the probability that
    is the Jaccard similarity of their n-grams, and in the whole signature with its ``rows``-th power.
    The empty word has the n-grams of its two marks; null stays null.
    """
    if rows < 1:
        raise ValueError(f"rows must be at least 1, got {rows}")

    def least(grams: Column) -> Column:
        hashed = lambda row: F.transform(grams, lambda gram: F.md5(F.concat(F.lit(f"{row}:"), gram)))
        return F.concat(*[F.substring(F.array_min(hashed(row)), 1, 8) for row in range(rows)])

    return bind(char_ngrams(F.concat(F.lit(BEGIN), word, F.lit(END)), n), least)


def similar_bucket(word: Column, buckets: int, rows: int = 2, n: int = 2) -> Column:
    """A bucket that similar words tend to share, where :func:`md5_bucket` spreads them."""
    return md5_bucket(similar_signature(word, rows, n), buckets)
