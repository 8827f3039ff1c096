"""Evaluate trained versions and compare the algorithms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textjury.operators.evaluation import evaluate, macro_average
from textjury.plans.registry import Ensemble, ModelStore
from textjury.plans.scoring import measure, out_of_fold, score
from textjury.plans.split import Split


def evaluate_version(store: ModelStore, split: Split, ensemble: Ensemble) -> DataFrame:
    """Per-fold metrics of a version, appended to the experiment table and returned from it."""
    version = ensemble.version
    store.record(version, evaluate(out_of_fold(split, ensemble, store), split.k))
    return store.experiments().where(
        (F.col("algorithm") == version.algorithm) & (F.col("run") == version.run)
    )


def comparison_board(
    store: ModelStore, split: Split, ensembles: Sequence[Ensemble], messages: DataFrame
) -> DataFrame:
    """One row per algorithm: mean precision, recall, F1 and seconds per scored message.

    The seconds come from scoring all of ``messages`` once per algorithm, cutting and
    hashing included, as each algorithm would run alone.
    """
    spark = store.spark
    timings = []
    for ensemble in ensembles:
        run = measure(score(messages, ensemble))
        timings.append((ensemble.algorithm, ensemble.version.run, run["seconds_per_message"]))
    seconds = spark.createDataFrame(timings, "algorithm STRING, run STRING, seconds DOUBLE")
    recorded = store.experiments().join(
        F.broadcast(seconds), ["algorithm", "run"]  # one row per ensemble
    )
    means = macro_average(recorded, by=("algorithm", "run", "seconds"))
    return means.select("algorithm", "precision", "recall", "f1", "seconds")
