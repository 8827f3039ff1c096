"""Text column to token array column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from textjury.functions import text as T
from textjury.functions.arrays import counted
from textjury.functions.hashing import BEGIN, END, similar_bucket

#: Characters in the n-grams of a signature; tokens whose signature a task keeps, and the longest of them.
SIMILAR_GRAM, CACHED_SIGNATURES, CACHED_LENGTH = 2, 50_000, 64

MODES: dict[str, Callable[[Column, int], Column]] = {
    "keep_all": lambda text, n: T.all_pieces(text),
    "mixed": T.mixed,
    "word": lambda text, n: T.words(text),
    "char_ngram": T.char_ngrams,
}


def clean_text(df: DataFrame, text: str = "text", out: str = "text_clean") -> DataFrame:
    return df.withColumn(out, T.clean(F.col(text)))


def tokens(text: Column, mode: str = "keep_all", n: int = 2, lowercase: bool = False) -> Column:
    """Token array of a text; a null text has no tokens."""
    if mode not in MODES:
        raise ValueError(f"unknown tokenizer mode {mode!r}, use one of {sorted(MODES)}")
    whole = F.coalesce(text, F.lit(""))
    return MODES[mode](F.lower(whole) if lowercase else whole, n)


def tokenize(
    df: DataFrame,
    mode: str = "keep_all",
    n: int = 2,
    lowercase: bool = False,
    text: str = "text",
    out: str = "words",
    similar: int | None = None,
) -> DataFrame:
    """Add the token array ``out``.

    ``keep_all`` keeps every piece of the text in order, blanks and punctuation
    included and case untouched. ``mixed`` does the same, but cuts runs of scripts
    without blanks into character n-grams. ``word`` keeps letters and digits only.
    ``char_ngram`` cuts everything into n-grams. Segmentation with a word list is
    :func:`textjury.operators.segmenting.segment`. With ``similar`` each token becomes its
    :func:`textjury.functions.hashing.similar_signature` of so many rows: whatever hashes the
    tokens later puts similar ones into one bucket.
    """
    cut = tokens(F.col(text), mode, n, lowercase)
    return df.withColumn(out, cut if similar is None else signatures(similar)(cut))


def signatures(rows: int) -> Callable[[Column], Column]:
    """:func:`textjury.functions.hashing.similar_signature` of each token of an array, worked out once per distinct token of a batch.

    Plain values and functions only, so that a worker can use them without this package.
    """
    if rows < 1:
        raise ValueError(f"rows must be at least 1, got {rows}")
    n, begin, end, kept, short = SIMILAR_GRAM, BEGIN, END, CACHED_SIGNATURES, CACHED_LENGTH

    @F.arrow_udf(ST.ArrayType(ST.StringType()))
    def sign_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from functools import lru_cache
        from hashlib import md5

        @lru_cache(maxsize=kept)  # tokens repeat
        def signature(token: str | None) -> str | None:
            if token is None:
                return None
            marked = begin + token + end
            grams = {marked[i : i + n] for i in range(len(marked) - n + 1)}
            return "".join(min(md5(f"{row}:{gram}".encode()).hexdigest() for gram in grams)[:8] for row in range(rows))

        for batch in batches:
            found = batch.flatten().dictionary_encode()
            asked = ((token, signature if token is None or len(token) <= short else signature.__wrapped__) for token in found.dictionary.to_pylist())
            signed = pa.array([sign(token) for token, sign in asked], pa.string())
            ends = np.concatenate([[0], np.cumsum(batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), signed.take(found.indices))

    return sign_all


def token_rows(df: DataFrame, key: str = "doc_id", words: str = "words") -> DataFrame:
    """One row per token with its position, starting at 0."""
    return df.select(key, F.posexplode(words).alias("pos", "token"))


def token_counts(
    df: DataFrame, key: str = "doc_id", words: str = "words", token: str = "token"
) -> DataFrame:
    """One row per distinct token of each message. No shuffle."""
    return df.select(key, F.inline(counted(F.col(words), token, "n")))


def vocabulary(df: DataFrame, words: str = "words") -> DataFrame:
    """Every token with its number of occurrences and of messages holding it.

    Counting inside the row first leaves one shuffle, and the map-side
    aggregation folds frequent tokens before it.
    """
    return (
        df.select(F.inline(counted(F.col(words), "token", "n")))
        .groupBy("token")
        .agg(F.sum("n").alias("term_count"), F.count(F.lit(1)).alias("doc_count"))
    )


def similar_words(df: DataFrame, num_buckets: int, rows: int = 2, n: int = 2, words: str = "words") -> DataFrame:
    """(token, bucket) of every distinct token, similar tokens tending to share a bucket.

    Tokens are made distinct before they are hashed, so a frequent one costs no more than a rare one.
    """
    distinct = df.select(F.explode(F.array_distinct(words)).alias("token")).where("token is not null").distinct()
    return distinct.withColumn("bucket", similar_bucket(F.col("token"), num_buckets, rows, n))
