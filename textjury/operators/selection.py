"""Feature selection per training set: chi-square of a bucket's presence and the label."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.operators.term_weights import buckets
from textjury.operators.vectors import ALL_MESSAGES, FEATURES, TF

SELECTED = "selected"


def chi_square(both: Column, bucket: Column, positive: Column, total: Column) -> Column:
    """Of the 2 x 2 table of presence and label, from its cell, its margins and its sum; 0 where a margin is empty.

    ``both`` counts positive messages with the bucket, ``bucket`` messages with it.
    """
    b, c, d = bucket - both, positive - both, total - bucket - positive + both
    margins = bucket * (total - bucket) * positive * (total - positive)
    apart = both * d - b * c
    return F.when(margins > 0, total * apart * apart / margins).otherwise(0.0)


def chi_square_by_fold(df: DataFrame, num_buckets: int, k: int, words: str = "words") -> DataFrame:
    """(held_out, bucket, df, chi_square) for all k training sets from one pass over (words, label, fold).

    Training set i has the counts of all folds minus those of fold i, and so have its margins.
    """
    held = F.concat(F.array(F.lit(ALL_MESSAGES)), F.array_distinct(buckets(F.col(words), num_buckets)))
    of_fold = lambda i, more=F.lit(True): F.count(F.when((F.col("fold") == i) & more, 1)).cast("double")
    counts = (
        df.select("fold", "label", F.explode(held).alias("bucket"))
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(
            F.array(*[F.struct(of_fold(i).alias("n"), of_fold(i, F.col("label") == 1).alias("pos")) for i in range(k)]).alias("by_fold"),
            F.max("bucket").alias("marker"),
        )
    )
    outside = F.transform(
        "by_fold",
        lambda own: F.struct(
            (F.aggregate("by_fold", F.lit(0.0), lambda a, x: a + x["n"]) - own["n"]).alias("n"),
            (F.aggregate("by_fold", F.lit(0.0), lambda a, x: a + x["pos"]) - own["pos"]).alias("pos"),
        ),
    )
    messages = counts.where(F.col("marker") == ALL_MESSAGES).select(outside.alias("all"))
    per_bucket = counts.where(F.col("marker") != ALL_MESSAGES).select("bucket", outside.alias("own"))
    both = F.arrays_zip(F.col("own"), F.col("all"))
    rows = per_bucket.withColumn("all", messages.scalar()).select("bucket", F.posexplode(both).alias("held_out", "of"))
    return rows.select(
        "held_out",
        "bucket",
        F.col("of.own.n").cast("bigint").alias("df"),
        chi_square(F.col("of.own.pos"), F.col("of.own.n"), F.col("of.all.pos"), F.col("of.all.n")).alias("chi_square"),
    )


def fold_label_frequency(vectors: DataFrame, k: int, num_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Messages, and positive messages, per (fold, bucket); in the last column per fold.

    One pass for all k folds; at most k * (num_features + 1) rows reach the driver, whatever
    the number of messages.
    """
    held = F.concat(F.array(F.lit(ALL_MESSAGES)), F.unwrap_udt(TF)["indices"])
    counts = (
        vectors.select("fold", "label", F.explode(held).alias("bucket"))
        .groupBy("fold", "bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("label") == 1, 1)).alias("pos"))
        .toPandas()
    )
    tables = np.zeros((2, k, num_features + 1))
    for table, name in zip(tables, ("n", "pos")):
        table[counts["fold"], counts["bucket"]] = counts[name]
    return tables[0], tables[1]


def best_buckets(n: np.ndarray, pos: np.ndarray, size: int) -> list[list[int]]:
    """For each training set its ``size`` buckets of highest chi-square, of equal ones the lower numbers; ascending."""
    chosen = []
    for fold in range(len(n)):
        have, both = n.sum(axis=0) - n[fold], pos.sum(axis=0) - pos[fold]
        total, positive = have[-1], both[-1]
        have, both = have[:-1], both[:-1]
        margins = have * (total - have) * positive * (total - positive)
        apart = both * (total - have - positive + both) - (have - both) * (positive - both)
        value = np.divide(total * apart * apart, margins, out=np.zeros_like(have), where=margins > 0)
        chosen.append(sorted(np.lexsort((np.arange(len(value)), -value))[:size].tolist()))
    return chosen


def selection_stage(indices: list[int]) -> VectorSlicer:
    return VectorSlicer(inputCol=FEATURES, outputCol=SELECTED, indices=indices)
