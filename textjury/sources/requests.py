"""Scoring requests: a message and the algorithm that shall judge it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textjury.functions.text import strip

MAX_LENGTH = 50
# Fixed request codes, in the order they are offered.
METHODS = ["SVM", "MP", "LR", "DT", "GBDT"]


def validate(df: DataFrame) -> DataFrame:
    """Strip the message and add ``ok``: 1 to 50 characters and a known method."""
    message = F.coalesce(strip(F.col("message")), F.lit(""))
    known = F.coalesce(F.col("method").isin(METHODS), F.lit(False))
    return df.withColumn("message", message).withColumn(
        "ok", F.length("message").between(1, MAX_LENGTH) & known
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests to score, and rejected ones."""
    checked = validate(df)
    return checked.where("ok").drop("ok"), checked.where("not ok").drop("ok")
