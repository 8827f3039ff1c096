"""Spam rate per time window over a stream of scored messages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch"


def windowed_counts(scored: DataFrame, time: str, window: str, slide: str | None = None, vote: str = "vote") -> DataFrame:
    """(window_start, window_end, n, n_spam) of a table or a stream with a watermark.

    Rows without a time are in no window; a missing vote is not spam.
    """
    spam = F.coalesce((F.col(vote) == 1).cast("long"), F.lit(0))
    counted = scored.where(F.col(time).isNotNull()).groupBy(F.window(time, window, slide).alias("w"))
    return counted.agg(F.count(F.lit(1)).alias("n"), F.sum(spam).alias("n_spam")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "n_spam"
    )


def spam_rate_stream(
    scored: DataFrame,
    sink: str,
    checkpoint: str,
    time: str = "ts",
    window: str = "1 hour",
    slide: str | None = None,
    lateness: str = "1 day",
    vote: str = "vote",
    available_now: bool = False,
) -> StreamingQuery:
    """Start keeping the spam rate of every window under ``sink``.

    State holds one row per open window. A row later than ``lateness`` behind the newest time
    seen is dropped, and windows older than that leave the state. Each batch writes the windows
    it changed to a folder of its own, which a repeated batch replaces: after a restart from
    the checkpoint no row counts twice.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch}")

    marked = scored.withWatermark(time, lateness)
    writer = (
        windowed_counts(marked, time, window, slide, vote)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def spam_rates(spark: SparkSession, sink: str) -> DataFrame | None:
    """(window_start, window_end, n, n_spam, spam_rate) as of the last batch; None before the first."""
    try:
        changes = spark.read.parquet(sink)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    newest = Window.partitionBy("window_start", "window_end").orderBy(F.desc(BATCH))
    latest = changes.withColumn("nth", F.row_number().over(newest)).where("nth = 1")
    return with_rate(latest.drop("nth", BATCH))


def with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("spam_rate", F.col("n_spam") / F.col("n"))
