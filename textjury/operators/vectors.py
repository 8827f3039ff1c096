"""Hashed term-frequency vectors and the k idf stages of a k-fold training."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import ElementwiseProduct, HashingTF
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS, TF, FEATURES = "words", "tf", "features"
ALL_MESSAGES = -1  # bucket number under which each message is counted once


def hashing_stage(num_features: int) -> HashingTF:
    return HashingTF(inputCol=WORDS, outputCol=TF, numFeatures=num_features)


def term_vectors(
    df: DataFrame, num_features: int, words: str = WORDS, out: str = TF
) -> DataFrame:
    return hashing_stage(num_features).setInputCol(words).setOutputCol(out).transform(df)


def fold_document_frequency(vectors: DataFrame, k: int, num_features: int) -> np.ndarray:
    """Messages per (fold, bucket) and, in the last column, messages per fold.

    One pass for all k folds. A map task emits at most ``k * (num_features + 1)``
    partial counts, and as many rows reach the driver: a bound set by the
    parameters, whatever the number of messages.
    """
    held = F.concat(F.array(F.lit(ALL_MESSAGES)), F.unwrap_udt(TF)["indices"])
    counts = (
        vectors.select("fold", F.explode(held).alias("bucket"))
        .groupBy("fold", "bucket")
        .agg(F.count(F.lit(1)).alias("df"))
        .toPandas()
    )
    table = np.zeros((k, num_features + 1))
    table[counts["fold"], counts["bucket"]] = counts["df"]
    return table


def idf_stages(by_fold: np.ndarray) -> list[ElementwiseProduct]:
    """Stage i weights by the messages outside fold i only.

    The document frequency of training set i is the total minus fold i, so no
    training set is counted twice.
    """
    training = by_fold.sum(axis=0) - by_fold
    return [idf_stage(row) for row in training]


def idf_stage(training: np.ndarray) -> ElementwiseProduct:
    """Weights from one training set's messages per bucket and, last, its number of messages."""
    weights = np.log((training[-1] + 1) / (training[:-1] + 1))
    return ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=TF, outputCol=FEATURES)
