"""The vote that users get, judged on messages that no voting member saw.

A member of a k-fold version saw all folds but one, so its version's vote can only be judged
on rows that most members learned from. Here a member leaves out two folds. The k - 1 members
that leave out fold i vote on fold i; each member serves both of its folds, so there are
k (k - 1) / 2 fits instead of k (k - 1).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import combinations

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textjury.operators.classifiers import DEFAULT_NUM_FEATURES, algorithm_code, check_classes, estimator
from textjury.operators.folds import held_out_rows
from textjury.operators.vectors import FEATURES, fold_document_frequency, hashing_stage, idf_stage
from textjury.operators.voting import majority_vote
from textjury.plans.registry import ModelStore
from textjury.plans.scoring import predict_member
from textjury.plans.split import Split
from textjury.plans.training import MAX_DENSE_BYTES, check_memory, fit_bytes, fit_tasks, fits_at_once, spread


def nested_vote(
    split: Split,
    store: ModelStore,
    algorithm: str,
    num_features: int | None = None,
    parallelism: int | None = None,
    max_dense_bytes: int = MAX_DENSE_BYTES,
) -> DataFrame:
    """(doc_id, label, fold, votes, prediction): each row with the vote of the k - 1 members that never saw its fold.

    At least three folds. The members are stored apart from the versions and not published.
    """
    if split.k < 3:
        raise ValueError(f"a nested vote takes at least 3 folds, got {split.k}")
    algorithm = algorithm_code(algorithm)
    spark = store.spark
    m = num_features or DEFAULT_NUM_FEATURES[algorithm]
    class_counts = split.class_counts(spark)
    pairs = list(combinations(range(split.k), 2))
    check_classes(algorithm, class_counts, pairs)
    n_rows = sum(c["n"] for c in class_counts)
    check_memory(algorithm, n_rows, m, max_dense_bytes)
    vectors = split.vectors(spark, m)
    frequency = fold_document_frequency(vectors, split.k, m)
    cores, entries = spark.sparkContext.defaultParallelism, int(frequency[:, :-1].sum())
    tasks = fit_tasks(algorithm, n_rows, m, entries, cores)
    root = f"{store.root}/nested/{algorithm}-{uuid.uuid4().hex[:8]}"

    def fit(pair: tuple[int, int]) -> PipelineModel:
        idf = idf_stage(frequency.sum(axis=0) - frequency[list(pair)].sum(axis=0))
        rows = spread(vectors.where(~F.col("fold").isin(*pair)), tasks)
        model = estimator(algorithm, m).fit(idf.transform(rows).select("label", FEATURES))
        path = f"{root}/without={pair[0]}-{pair[1]}"
        PipelineModel(stages=[hashing_stage(m), idf, model]).write().save(path)
        return PipelineModel.load(path)

    at_once = parallelism or fits_at_once(cores, tasks, len(pairs), fit_bytes(algorithm, n_rows, m, entries))
    with ThreadPoolExecutor(at_once) as pool:
        members = dict(zip(pairs, pool.map(inheritable_thread_target(spark)(fit), pairs)))
    parts = []
    for fold in range(split.k):
        scored, names = held_out_rows(vectors, fold), []
        for pair, member in members.items():
            if fold in pair:
                names.append(f"p{len(names)}")
                scored = predict_member(scored, member, names[-1])
        voted = majority_vote(scored, names, "votes", "vote")
        parts.append(voted.select("doc_id", "label", "fold", "votes", F.col("vote").cast("double").alias("prediction")))
    return reduce(DataFrame.unionByName, parts)
