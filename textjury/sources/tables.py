"""Tables in, labelled and unlabelled messages out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SPREAD_BYTES, SPREAD_BYTES_PER_TASK = 1024 * 1024 * 1024, 32 * 1024 * 1024


def at_least(df: DataFrame, partitions: int | None = None, key: str = "doc_id") -> DataFrame:
    """Spread a scan that has fewer partitions than asked for (default: one per core).

    By default a task then gets about ``SPREAD_BYTES_PER_TASK`` at most, also where few cores
    have registered yet. Only for few, unsplittable files: an input of more than
    ``SPREAD_BYTES``, and a scan that already feeds every core, is returned unchanged. The rows
    are the same either way.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    if size > SPREAD_BYTES or df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted if partitions else max(wanted, -(-size // SPREAD_BYTES_PER_TASK)), key)


def labelled_messages(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id"
) -> DataFrame:
    """(key, label, text) of the messages that have a label."""
    return documents.select(key, "text").join(
        labels.select(key, F.col(label).cast("double").alias("label")).where("label is not null"),
        key,
    ).select(key, "label", "text")


def unlabelled_messages(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id"
) -> DataFrame:
    """(key, text) of the messages without a label; a null label is none."""
    return documents.select(key, "text").join(
        labels.where(F.col(label).isNotNull()).select(key), key, "left_anti"
    )


def first_messages(df: DataFrame, n: int = 100, key: str = "doc_id") -> DataFrame:
    """The first ``n`` messages in key order: a top-n per task, then one merge of n rows each."""
    return df.select(key, "text").orderBy(key).limit(n)


def append_messages(labelled: DataFrame, path: str) -> None:
    """Add (doc_id, label, text) rows to a labelled table; rows already there keep their fold."""
    labelled.select("doc_id", "label", "text").write.mode("append").parquet(path)


def store_by_key(df: DataFrame, table: str, buckets: int, key: str = "doc_id") -> None:
    """Save a table bucketed by key.

    Messages and labels saved with the same number of buckets join without a
    shuffle, each time the labelled set is built from a large table.
    """
    df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)
