"""Add labelled lines to the labelled table while they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textjury.sources.lines import checked_lines
from textjury.streaming.scoring import start_file_sink


def ingest_labelled(
    lines: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append the lines of a text stream to ``path``, good and bad ones in one query.

    One checkpoint covers both, and the stream is read and parsed once. A line whose label
    is not 0 or 1 is bad: it would stop every later training.
    """
    checked = checked_lines(lines.withColumn("doc_id", F.md5("value")))
    rows = checked.withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value")))
    return start_file_sink(
        rows.select("doc_id", "label", "text", "value", "problem"), path, checkpoint, available_now
    )


def ingested(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What arrived: (doc_id, label, text) to train on, and (doc_id, value, problem) of bad lines."""
    rows = spark.read.parquet(path)
    return (
        rows.where("problem is null").select("doc_id", "label", "text"),
        rows.where("problem is not null").select("doc_id", "value", "problem"),
    )
