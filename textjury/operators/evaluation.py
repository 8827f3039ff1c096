"""Confusion counts and the metrics made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textjury.functions import metrics as M
from textjury.operators.folds import per_fold


def confusion_counts(df: DataFrame, k: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """tp, fp and fn per fold in one aggregation.

    fn is every wrong row not predicted 1. A row without label or prediction
    counts nowhere. With ``k`` given, folds that hold no row appear with zeros.
    """
    wrong = F.col("label") != F.col("prediction")
    right = F.col("label") == F.col("prediction")
    said_one = F.col("prediction") == 1

    def count(condition):
        return F.count(F.when(condition, 1))

    if k is None or not by:
        counts = df.groupBy(*by, "fold").agg(
            count(right & said_one).alias("tp"),
            count(wrong & said_one).alias("fp"),
            count(wrong & ~said_one).alias("fn"),
        )
        return counts if k is None else per_fold(counts, k)

    # One row per group with the counts of all folds, so the input is read once.
    def in_fold(fold: int, condition):
        return count((F.col("fold") == fold) & condition)

    folds = [
        F.struct(
            in_fold(i, right & said_one).alias("tp"),
            in_fold(i, wrong & said_one).alias("fp"),
            in_fold(i, wrong & ~said_one).alias("fn"),
        )
        for i in range(k)
    ]
    grouped = df.groupBy(*by).agg(F.array(*folds).alias("folds"))
    return grouped.select(*by, F.posexplode("folds").alias("fold", "c")).select(*by, "fold", "c.*")


def with_metrics(counts: DataFrame) -> DataFrame:
    return (
        counts.withColumn("precision", M.precision(F.col("tp"), F.col("fp")))
        .withColumn("recall", M.recall(F.col("tp"), F.col("fn")))
        .withColumn("f1", M.f1(F.col("precision"), F.col("recall")))
    )


def evaluate(out_of_fold: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Per-fold metrics of a table (label, fold, prediction)."""
    return with_metrics(confusion_counts(out_of_fold, k, by))


def macro_average(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Means over the folds. The mean F1 is the mean of F1s."""
    return metrics.groupBy(*by).agg(
        *[F.avg(name).alias(name) for name in ("precision", "recall", "f1")]
    )
