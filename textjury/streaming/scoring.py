"""Score a stream of messages or requests with the batch plans.

Scoring is stateless: no watermark, no state store. The checkpoint must be on
shared storage; with the file sink's log it gives each input row one output row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textjury.operators.voting import verdict
from textjury.plans.registry import Ensemble
from textjury.plans.scoring import score, score_by_method
from textjury.sources.requests import validate


def start_file_sink(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append a stream to Parquet files, until stopped or for what has arrived."""
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def score_stream(
    messages: DataFrame,
    ensemble: Ensemble,
    sink: str,
    checkpoint: str,
    columns: tuple[str, ...] = ("doc_id", "votes", "vote"),
    available_now: bool = False,
) -> StreamingQuery:
    """Start writing votes under ``sink``."""
    return start_file_sink(score(messages, ensemble).select(*columns), sink, checkpoint, available_now)


def judge_requests(requests: DataFrame, ensembles: Sequence[Ensemble]) -> DataFrame:
    """Add ``ok``, ``vote`` and ``verdict`` to (message, method) requests.

    An invalid request keeps its row, with neither vote nor verdict: no ensemble
    is asked, so it is not scored.
    """
    checked = validate(requests).withColumnRenamed("method", "asked_method")
    routed = checked.withColumn("method", F.when(F.col("ok"), F.col("asked_method")))
    judged = score_by_method(routed, ensembles).drop("method")
    return judged.withColumnRenamed("asked_method", "method").withColumn(
        "verdict", verdict(F.col("vote"))
    )


def answer_requests(
    requests: DataFrame,
    ensembles: Sequence[Ensemble],
    sink: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Start answering a stream of requests, each with the algorithm it names."""
    return start_file_sink(judge_requests(requests, ensembles), sink, checkpoint, available_now)
