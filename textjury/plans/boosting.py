"""Boosted ensembles: rounds of weak classifiers, each trained on what the rounds before got wrong.

Every round fits one weak classifier per fold with row weights. Each row is judged by the
member that never saw it, so the round's weighted error, and with it the round's say (alpha),
are out of fold. Rows judged wrongly gain weight for the next round.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import add

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.operators.classifiers import DEFAULT_NUM_FEATURES, algorithm_code, check_classes, estimator
from textjury.operators.folds import held_out_rows, training_rows
from textjury.operators.vectors import FEATURES, fold_document_frequency, hashing_stage, idf_stages, term_vectors
from textjury.operators.voting import majority_vote
from textjury.plans.registry import ModelStore, ModelVersion
from textjury.plans.scoring import predict_member
from textjury.plans.split import Split, folders_at_size, with_words
from textjury.plans.storage import append_record, read_records
from textjury.plans.training import MAX_DENSE_BYTES, check_memory, fit_bytes, fit_tasks, fits_at_once, spread

WEIGHT = "weight"
ROUNDS = "round INT, error DOUBLE, alpha DOUBLE"
#: An error is kept this far from 0 and 1, so a faultless round has a large but finite say.
LEAST_ERROR = 1e-10


@dataclass(frozen=True)
class Boosted:
    """A published version: ``rounds[t][i]`` is the weak classifier of round t that never saw fold i."""

    version: ModelVersion
    rounds: tuple[tuple[PipelineModel, ...], ...]
    alphas: tuple[float, ...]
    errors: tuple[float, ...]


def boosted_store(store: ModelStore) -> ModelStore:
    """Boosted versions have a registry of their own under the same root."""
    return ModelStore(store.spark, f"{store.root}/boosted")


def alpha_of(error: float) -> float:
    """A round's say: half the log odds of being right."""
    kept = min(max(error, LEAST_ERROR), 1 - LEAST_ERROR)
    return 0.5 * math.log((1 - kept) / kept)


def reweighted(weight: Column, right: Column, alpha: float) -> Column:
    return weight * F.when(right, math.exp(-alpha)).otherwise(math.exp(alpha))


def _weighted_error(judged: DataFrame) -> tuple[float, float]:
    """Share of the weight on wrongly judged rows, and the mean weight."""
    row = judged.agg(
        F.sum(F.when(F.col("prediction") != F.col("label"), F.col(WEIGHT)).otherwise(0.0)).alias("wrong"),
        F.sum(WEIGHT).alias("total"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    return row["wrong"] / row["total"], row["total"] / row["n"]


def train_boosted(
    split: Split,
    store: ModelStore,
    algorithm: str = "DT",
    rounds: int = 5,
    num_features: int | None = None,
    settings: dict | None = None,
    parallelism: int | None = None,
    max_dense_bytes: int = MAX_DENSE_BYTES,
) -> Boosted:
    """Train up to ``rounds`` rounds and publish them as the next boosted version of ``algorithm``.

    ``settings`` are parameters of the weak classifier, for example ``{"maxDepth": 1}``. Boosting
    ends early with a round that is faultless (kept) or no better than chance (dropped, unless it
    is the first). Each round's judged rows are stored with the version by fold, so a lost
    executor costs a re-read, and the next round's weights are a projection of them.
    """
    algorithm = algorithm_code(algorithm)
    m = num_features or DEFAULT_NUM_FEATURES[algorithm]
    weak = estimator(algorithm, m)
    if not weak.hasParam("weightCol"):
        raise ValueError(f"{algorithm} cannot weigh its rows, so it cannot be boosted")
    weak = weak.copy({weak.getParam(name): value for name, value in (settings or {}).items()}).setWeightCol(WEIGHT)
    if rounds < 1:
        raise ValueError(f"rounds must be at least 1, got {rounds}")
    target = boosted_store(store)
    spark = store.spark
    class_counts = split.class_counts(spark)
    check_classes(algorithm, class_counts)
    n_rows = sum(c["n"] for c in class_counts)
    check_memory(algorithm, n_rows, m, max_dense_bytes)

    number = target.claim_version(algorithm)
    path = target.new_path(algorithm, number)
    vectors = split.vectors(spark, m)
    frequency = fold_document_frequency(vectors, split.k, m)
    weights = idf_stages(frequency)
    cores, entries = spark.sparkContext.defaultParallelism, int(frequency[:, :-1].sum())
    tasks = fit_tasks(algorithm, n_rows, m, entries, cores)
    at_once = parallelism or fits_at_once(cores, tasks, split.k, fit_bytes(algorithm, n_rows, m, entries))
    started = time.perf_counter()
    rows = vectors.select("doc_id", "label", "tf", "fold", F.lit(1.0).alias(WEIGHT))
    for t in range(rounds):

        def fit(fold: int) -> None:
            own = spread(training_rows(rows, fold), tasks)
            model = weak.fit(weights[fold].transform(own).select("label", FEATURES, WEIGHT))
            PipelineModel(stages=[hashing_stage(m), weights[fold], model]).write().save(member_path(path, t, fold))

        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(inheritable_thread_target(spark)(fit), range(split.k)))
        judged = judged_rows(rows, load_round(path, t, split.k))
        folders_at_size(judged, split.k).write.partitionBy("fold").parquet(f"{path}/judged/round={t}")
        judged = round_rows(spark, path, t)
        error, mean = _weighted_error(judged)
        if error >= 0.5 and t > 0:
            break
        alpha = alpha_of(error)
        append_record(spark, f"{path}/rounds", {"round": t, "error": error, "alpha": alpha}, ROUNDS)
        if error <= LEAST_ERROR or error >= 0.5:
            break
        # Weights stay near 1: the learners' own tolerances see the same scale in every round.
        right = F.col("prediction") == F.col("label")
        scale = 2 * math.sqrt(error * (1 - error)) * mean
        rows = judged.select("doc_id", "label", "tf", "fold", (reweighted(F.col(WEIGHT), right, alpha) / scale).alias(WEIGHT))

    target.publish(
        ModelVersion(
            algorithm=algorithm,
            version=number,
            path=path,
            k=split.k,
            num_features=m,
            tokenizer=json.dumps(split.tokenizer, sort_keys=True),
            split=split.path,
            n_rows=n_rows,
            fit_seconds=time.perf_counter() - started,
            created_at=datetime.now(timezone.utc).isoformat(),
        )
    )
    return load_boosted(store, algorithm)


def member_path(path: str, t: int, fold: int) -> str:
    return f"{path}/members/round={t}/member={fold}"


def load_round(path: str, t: int, k: int) -> tuple[PipelineModel, ...]:
    return tuple(PipelineModel.load(member_path(path, t, fold)) for fold in range(k))


def load_boosted(store: ModelStore, algorithm: str) -> Boosted:
    """The latest boosted version; without one, or with an incomplete one, an error."""
    version = boosted_store(store).require(algorithm)
    recorded = read_records(store.spark, f"{version.path}/rounds", ROUNDS)
    if recorded is None:
        raise RuntimeError(f"no rounds under {version.path}")
    rows = recorded.orderBy("round").collect()  # one row per round
    return Boosted(
        version,
        tuple(load_round(version.path, r["round"], version.k) for r in rows),
        tuple(r["alpha"] for r in rows),
        tuple(r["error"] for r in rows),
    )


def round_rows(spark: SparkSession, path: str, t: int) -> DataFrame:
    """(doc_id, label, tf, weight, prediction, fold) as judged in round ``t``."""
    return spark.read.parquet(f"{path}/judged/round={t}")


def judged_rows(rows: DataFrame, members: Sequence[PipelineModel]) -> DataFrame:
    """``rows`` with the ``prediction`` of the member that never saw them."""
    parts = [
        predict_member(held_out_rows(rows, fold), member, "prediction").drop("prediction_features")
        for fold, member in enumerate(members)
    ]
    return reduce(DataFrame.unionByName, parts)


def _weighted_say(df: DataFrame, boosted: Boosted, fold: int, out: str) -> DataFrame:
    """Add ``out``: 1 if the rounds' weak classifiers of ``fold`` say so by their alphas, more than not."""
    names = [f"{out}_r{t}" for t in range(len(boosted.rounds))]
    scored = df
    for name, members in zip(names, boosted.rounds):
        scored = predict_member(scored, members[fold], name)
    say = reduce(add, [F.lit(alpha) * (2 * F.col(name) - 1) for alpha, name in zip(boosted.alphas, names)])
    return scored.withColumn(out, (say > 0).cast("double")).drop(*names, *[f"{n}_features" for n in names])


def score_boosted(df: DataFrame, boosted: Boosted) -> DataFrame:
    """Add p0..p{k-1}, ``votes`` and ``vote``: the strict majority of the k boosted members. Serves tables and streams."""
    tokenised = with_words(df, boosted.version.tokenizer_settings())
    scored = term_vectors(tokenised, boosted.version.num_features)
    names = [f"p{i}" for i in range(boosted.version.k)]
    for fold, name in enumerate(names):
        scored = _weighted_say(scored, boosted, fold, name)
    return majority_vote(scored, names).drop("words", "tf")


def boosted_out_of_fold(split: Split, boosted: Boosted, store: ModelStore) -> DataFrame:
    """(doc_id, label, fold, prediction): each row judged by the boosted member that never saw it."""
    if boosted.version.split != split.path or boosted.version.k != split.k:
        raise RuntimeError("the boosted version was trained on another split: its members may have seen these rows")
    vectors = split.vectors(store.spark, boosted.version.num_features)
    parts = [
        _weighted_say(held_out_rows(vectors, fold), boosted, fold, "prediction").select("doc_id", "label", "fold", "prediction")
        for fold in range(split.k)
    ]
    return reduce(DataFrame.unionByName, parts)
