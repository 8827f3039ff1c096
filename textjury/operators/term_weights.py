"""Hashed term frequency, document frequency, idf and tf-idf in long form.

The SQL-checkable twin of :mod:`textjury.operators.vectors`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.functions.arrays import counted
from textjury.functions.hashing import md5_bucket
from textjury.operators.vectors import ALL_MESSAGES

# A bucket table up to this many rows of (int, bigint, double) is a few MB.
BROADCAST_BUCKETS = 262_144


def buckets(words: Column, num_buckets: int) -> Column:
    return F.transform(words, lambda word: md5_bucket(word, num_buckets))


def hashed_tf(
    df: DataFrame, num_buckets: int, key: str = "doc_id", words: str = "words"
) -> DataFrame:
    """Occurrences per bucket and message; counted in the row, no shuffle."""
    return df.select(key, F.inline(counted(buckets(F.col(words), num_buckets), "bucket", "tf")))


def document_frequency(df: DataFrame, num_buckets: int, words: str = "words") -> DataFrame:
    """Messages holding each bucket. At most ``num_buckets`` rows leave a map task."""
    distinct = F.array_distinct(buckets(F.col(words), num_buckets))
    return (
        df.select(F.explode(distinct).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def idf_weight(m: Column, df: Column) -> Column:
    return F.log((m + 1) / (df + 1))


def _frequency_by_fold(
    df: DataFrame, num_buckets: int, k: int, fold: Column, words: str
) -> tuple[DataFrame, DataFrame]:
    """(bucket, n: messages per fold as array) and the same array for all messages.

    Each message also counts under the bucket ``ALL_MESSAGES``, so one pass
    gives both. The two results differ in a filter on an aggregate, which stays
    above the shuffle and lets Spark reuse it.
    """
    distinct = F.array_distinct(buckets(F.col(words), num_buckets))
    held = F.concat(F.array(F.lit(ALL_MESSAGES)), distinct)
    counts = (
        df.select(fold.alias("in_fold"), F.explode(held).alias("bucket"))
        .where("bucket is not null")  # never null; a later join adds this filter to one side only
        .groupBy("bucket")
        .agg(
            F.array(*[F.count(F.when(F.col("in_fold") == i, 1)) for i in range(k)]).alias("n"),
            F.max("bucket").alias("marker"),
        )
    )
    return split_messages(counts)


def split_messages(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bucket, n) of the buckets and (m) of all messages, from (bucket, n, marker)."""
    per_bucket = counts.where(F.col("marker") != ALL_MESSAGES).select("bucket", "n")
    messages = counts.where(F.col("marker") == ALL_MESSAGES).select(F.col("n").alias("m"))
    return per_bucket, messages


def idf(df: DataFrame, num_buckets: int, words: str = "words") -> DataFrame:
    per_bucket, messages = _frequency_by_fold(df, num_buckets, 1, F.lit(0), words)
    frequency, m = F.get("n", F.lit(0)), F.get("m", F.lit(0))
    return per_bucket.withColumn("m", messages.scalar()).select(
        "bucket", frequency.alias("df"), idf_weight(m, frequency).alias("idf")
    )


def idf_leave_one_out(df: DataFrame, num_buckets: int, k: int, words: str = "words") -> DataFrame:
    """The k idf tables of k training sets from one pass over the messages.

    Training set i has the total document frequency minus that of fold i.
    """
    return idf_of_training_sets(*_frequency_by_fold(df, num_buckets, k, F.col("fold"), words))


def idf_of_training_sets(per_bucket: DataFrame, messages: DataFrame) -> DataFrame:
    """(held_out, bucket, df, idf) from the messages per fold: (bucket, n) of each bucket and (m) of all."""

    def outside(n: Column) -> Column:
        total = F.aggregate(n, F.lit(0).cast("bigint"), lambda acc, own: acc + own)
        return F.transform(n, lambda own: total - own)

    both = F.arrays_zip(outside(F.col("n")).alias("df"), outside(F.col("m")).alias("m"))
    return (
        per_bucket.withColumn("m", messages.scalar())
        .select("bucket", F.posexplode(both).alias("held_out", "of"))
        .select(
            "held_out",
            "bucket",
            F.col("of.df").alias("df"),
            idf_weight(F.col("of.m"), F.col("of.df")).alias("idf"),
        )
    )


def tfidf(
    df: DataFrame,
    num_buckets: int,
    key: str = "doc_id",
    words: str = "words",
    weights: DataFrame | None = None,
) -> DataFrame:
    """``tf * idf`` per message and bucket.

    The weight table has at most ``num_buckets`` rows, so its size is known
    before the join: broadcast while small, otherwise left to Catalyst.
    """
    table = idf(df, num_buckets, words) if weights is None else weights
    if num_buckets <= BROADCAST_BUCKETS:
        table = F.broadcast(table)
    return (
        hashed_tf(df, num_buckets, key, words)
        .join(table, "bucket")
        .select(key, "bucket", (F.col("tf") * F.col("idf")).alias("tfidf"))
    )


def hash_collisions(df: DataFrame, sizes: list[int], words: str = "words") -> DataFrame:
    """How many words share a bucket when the words are hashed to M buckets.

    Only the distinct words are hashed, once for all M; then (M, bucket) counts.
    """
    distinct = df.select(F.explode(F.array_distinct(words)).alias("word")).distinct()
    hashed = distinct.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("num_buckets"), md5_bucket(F.col("word"), m).alias("bucket"))
                    for m in sizes
                ]
            )
        )
    )
    per_bucket = hashed.groupBy("num_buckets", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return per_bucket.groupBy("num_buckets").agg(
        F.sum("n").alias("n_words"),
        F.count(F.lit(1)).alias("n_buckets_used"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n_colliding"),
    )
