"""Train one classifier per fold and publish them as a new version."""

from __future__ import annotations

import json
import math
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Any

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from textjury.operators.classifiers import (
    DEFAULT_NUM_FEATURES,
    algorithm_code,
    check_classes,
    estimator,
    warm_started,
)
from textjury.operators.folds import training_rows
from textjury.operators.selection import best_buckets, fold_label_frequency, selection_stage
from textjury.operators.sparse_trees import can_grow, grow, grow_tasks
from textjury.operators.vectors import (
    TF,
    fold_document_frequency,
    hashing_stage,
    idf_stages,
)
from textjury.plans.registry import Ensemble, ModelStore, ModelVersion
from textjury.plans.split import Split, build_split, fold_settings

BYTES_PER_TASK, MOST_BYTES_PER_TASK = 64 * 1024 * 1024, 1024**3
#: Cached rows, per core, of all fits that run at once.
BYTES_PER_CORE = 512 * 1024 * 1024
SPARSE_ENTRY_BYTES, DENSE_ENTRY_BYTES = 12, 4
#: Partitions of a scan for each task of a fit from which on they are merged instead of shuffled.
MERGED_PER_TASK = 8
TREES = ("DT", "GBDT")
#: Dense rows of one tree fit up to which Spark ML's learner, with fewer passes of less each, takes no longer than the one for sparse rows.
DENSE_TREE_BYTES = 256 * 1024 * 1024
#: Memory that the dense rows of one tree fit may take on all executors together.
MAX_DENSE_BYTES = 64 * 1024**3


def train(
    labelled: DataFrame,
    store: ModelStore,
    algorithm: str,
    k: int = 5,
    num_features: int | None = None,
    salt: str = "",
    tokenizer: dict[str, Any] | None = None,
    source_version: str | None = None,
    replace: bool = False,
    parallelism: int | None = None,
    max_dense_bytes: int = MAX_DENSE_BYTES,
    select: int | None = None,
    warm_start: bool = False,
) -> Ensemble:
    """Split (doc_id, label, text), fit k members, publish them as a version.

    Refused when the algorithm has a published version, unless ``replace``.
    """
    algorithm = algorithm_code(algorithm)
    _may_train(store, algorithm, replace)
    split = build_split(
        labelled, store.root, k, salt, tokenizer, source_version=source_version
    )
    return train_on_split(split, store, algorithm, num_features, replace, parallelism, max_dense_bytes, select, warm_start)


def retrain(labelled: DataFrame, store: ModelStore, algorithm: str, **settings) -> Ensemble:
    """Periodic job: train on the table as it is now and publish the next version."""
    return train(labelled, store, algorithm, replace=True, **settings)


def train_on_split(
    split: Split,
    store: ModelStore,
    algorithm: str,
    num_features: int | None = None,
    replace: bool = False,
    parallelism: int | None = None,
    max_dense_bytes: int = MAX_DENSE_BYTES,
    select: int | None = None,
    warm_start: bool = False,
) -> Ensemble:
    """Fit a member for each fold on all other folds, some fits at a time.

    A fit is many short jobs, so several at once keep the cores busy; each one
    caches its own training rows, so ``parallelism`` bounds the memory in use.
    Without it, fits share the cluster until their tasks fill every core. The trees of a large
    table are grown for all folds at once by :mod:`textjury.operators.sparse_trees`, the others by Spark ML's
    learners, which keep a dense row of bins per message. A tree fit whose dense rows come to more than
    ``max_dense_bytes`` is refused before it starts. Set that to what your executors can
    cache, or choose ``num_features`` by it, or let each member keep only the ``select``
    buckets that have the highest chi-square with the label in its own training set.

    With ``warm_start`` each perceptron begins at the shrunken weights that the latest version has for
    its fold, which takes fewer iterations when the table has grown a little. The first version begins
    at random. A version whose rows fall into other folds is refused: its member has seen the rows
    that the new one is judged on.
    """
    algorithm = algorithm_code(algorithm)
    previous = _may_train(store, algorithm, replace)
    spark = store.spark
    m = num_features or DEFAULT_NUM_FEATURES[algorithm]
    class_counts = split.class_counts(spark)
    check_classes(algorithm, class_counts)
    width = m if select is None else min(select, m)
    if width < 1:
        raise ValueError(f"select must be at least 1, got {select}")
    check_memory(algorithm, sum(c["n"] for c in class_counts), width, max_dense_bytes)

    begin = _warm_members(store, previous, algorithm, split, m, select) if warm_start else None

    version = store.claim_version(algorithm)
    path = store.new_path(algorithm, version)
    vectors = split.vectors(spark, m)
    if select is None:
        frequency, chosen = fold_document_frequency(vectors, split.k, m), None
    else:
        frequency, positive = fold_label_frequency(vectors, split.k, m)
        chosen = best_buckets(frequency, positive, width)
    weights = idf_stages(frequency)
    n_rows = sum(c["n"] for c in class_counts)
    cores, entries = spark.sparkContext.defaultParallelism, int(frequency[:, :-1].sum())
    tasks = fit_tasks(algorithm, n_rows, width, entries, cores)
    started = time.perf_counter()
    grown = None
    if select is None and _grows_sparse(algorithm, class_counts, width):
        grown = _grown(vectors, weights, frequency[:, -1], estimator(algorithm, width), grow_tasks(entries, cores))

    def fit(fold: int) -> None:
        if grown is not None:
            PipelineModel(stages=[hashing_stage(m), weights[fold], grown[fold]]).write().save(f"{path}/member={fold}")
            return
        stages = [weights[fold]] if chosen is None else [weights[fold], selection_stage(chosen[fold])]
        rows = spread(training_rows(vectors, fold), tasks)
        for stage in stages:
            rows = stage.transform(rows)
        features = stages[-1].getOutputCol()
        learner = estimator(algorithm, width).setFeaturesCol(features)
        if begin is not None:
            learner = warm_started(learner, begin[fold].stages[-1])
        model = learner.fit(rows.select("label", features))
        member = PipelineModel(stages=[hashing_stage(m), *stages, model])
        member.write().save(f"{path}/member={fold}")

    at_once = parallelism or fits_at_once(cores, tasks, split.k, fit_bytes(algorithm, n_rows, width, entries))
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(inheritable_thread_target(spark)(fit), range(split.k)))

    trained = ModelVersion(
        algorithm=algorithm,
        version=version,
        path=path,
        k=split.k,
        num_features=m,
        tokenizer=json.dumps(split.tokenizer, sort_keys=True),
        split=split.path,
        n_rows=n_rows,
        fit_seconds=time.perf_counter() - started,
        created_at=datetime.now(timezone.utc).isoformat(),
    )
    store.publish(trained)
    # A freshly fitted model drags its training summary, and with it the session,
    # into every scoring task. What comes from the store is the bare model.
    return store.load(trained)


def _grows_sparse(algorithm: str, class_counts: list[dict], num_features: int) -> bool:
    """Whether all trees are grown in one go; Spark ML's decision tree says itself that it needs a row of label 1."""
    n_rows, ones = (sum(c[name] for c in class_counts) for name in ("n", "n_one"))
    if algorithm not in TREES or fit_bytes(algorithm, n_rows, num_features, 0) <= DENSE_TREE_BYTES:
        return False
    learnable = algorithm == "GBDT" or all(ones > c["n_one"] for c in class_counts)
    return learnable and can_grow(estimator(algorithm, num_features))


def _grown(vectors: DataFrame, weights: list, by_fold: np.ndarray, learner: Any, tasks: int) -> list:
    """The tree models of all training sets."""
    factors = np.stack([stage.getScalingVec().toArray() for stage in weights])
    rows = spread(vectors.select("label", "fold", TF), tasks)
    learner = learner.setFeaturesCol(weights[0].getOutputCol())
    return grow(rows, factors, by_fold.sum() - by_fold, learner, tasks)


def _warm_members(
    store: ModelStore, previous: ModelVersion | None, algorithm: str, split: Split, m: int, select: int | None
) -> tuple[PipelineModel, ...] | None:
    """The latest version's members, if a training on ``split`` may begin at them; None without a version."""
    if algorithm != "MP":
        raise ValueError(f"{algorithm} has no warm start, only MP has")
    if select is not None:
        raise ValueError("no warm start with select: each version chooses its own buckets")
    if previous is None:
        return None
    if previous.num_features != m:
        raise ValueError(f"version {previous.version} has {previous.num_features} buckets, not {m}")
    if fold_settings(store.spark, previous.split) != fold_settings(store.spark, split.path):
        raise ValueError(f"version {previous.version} was trained with other folds or another tokenizer")
    members = store.load(previous).members
    if len(members[0].stages) != 3:
        raise ValueError(f"version {previous.version} chose its own buckets")
    return members


def check_memory(algorithm: str, n_rows: int, num_features: int, most: int) -> None:
    """Refuse a tree fit whose dense rows are larger than ``most`` bytes."""
    size = n_rows * num_features * DENSE_ENTRY_BYTES
    if algorithm in TREES and size > most:
        fitting = most // (n_rows * DENSE_ENTRY_BYTES)
        raise ValueError(
            f"{algorithm} keeps {num_features} bins per message: {size / 1e9:.1f} GB for {n_rows} messages, "
            f"more than max_dense_bytes; num_features up to {fitting} would fit"
        )


def fit_bytes(algorithm: str, n_rows: int, num_features: int, entries: int) -> int:
    """Memory that the rows of one fit take: the ``entries`` non-zero values in the linear models, else a dense row per message."""
    sparse = algorithm in ("LR", "SVM")
    return entries * SPARSE_ENTRY_BYTES if sparse else n_rows * num_features * DENSE_ENTRY_BYTES


def fit_tasks(algorithm: str, n_rows: int, num_features: int, entries: int, cores: int | None = None) -> int:
    """Tasks worth having in one fit, by the memory its rows take in the estimator.

    Used with :func:`spread`. In a small table each iteration would otherwise pay a scheduling
    round per task; in a large one each pass a gradient, or a tree node's histogram over all
    buckets, per task. So with ``cores`` given there are no more
    tasks than cores unless one would hold over ``MOST_BYTES_PER_TASK``, and of the numbers
    nearby the gradient learners get one of which few partial sums reach the driver.
    """
    size = fit_bytes(algorithm, n_rows, num_features, entries)
    tasks = max(1, math.ceil(size / BYTES_PER_TASK))
    if cores is None:
        return tasks
    tasks = min(tasks, max(cores, math.ceil(size / MOST_BYTES_PER_TASK)))
    if algorithm in TREES:
        return tasks
    return min(range(math.ceil(tasks * 3 / 4), 2 * tasks + 1), key=lambda n: (partial_sums(n), abs(n - tasks)))


def spread(rows: DataFrame, tasks: int) -> DataFrame:
    """``rows`` in ``tasks`` partitions of about as many rows each.

    A fit passes over its rows hundreds of times, and a pass lasts as long as its fullest task. A scan
    has about as many partitions as there are cores, of uneven size, so merging them would leave tasks
    with twice the rows of others; where there are ``MERGED_PER_TASK`` for each task, merging is even
    enough and spares the shuffle.
    """
    if tasks == 1 or rows.rdd.getNumPartitions() >= MERGED_PER_TASK * tasks:
        return rows.coalesce(tasks)
    return rows.repartition(tasks)


def partial_sums(tasks: int) -> int:
    """Partial sums that ``treeAggregate`` of depth 2 leaves to the driver."""
    scale = max(2, math.ceil(math.sqrt(tasks)))
    while tasks > scale + math.ceil(tasks / scale):
        tasks //= scale
    return tasks


def fits_at_once(cores: int, tasks: int, k: int, size: int = 0) -> int:
    """All k fits while their tasks come to a few waves and their rows of ``size`` bytes each to ``BYTES_PER_CORE``; one by one on a large table."""
    fitting = k if size == 0 else cores * BYTES_PER_CORE // size
    return max(1, min(k, 5 * cores // tasks, fitting))


def _may_train(store: ModelStore, algorithm: str, replace: bool) -> ModelVersion | None:
    previous = store.latest(algorithm)
    if previous is not None and not replace:
        raise RuntimeError(
            f"{algorithm} version {previous.version} exists; pass replace=True to train the next"
        )
    return previous
