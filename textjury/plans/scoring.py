"""Score whole tables or streams with the k members of a version."""

from __future__ import annotations

import time
from collections.abc import Sequence
from hashlib import md5

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textjury.operators.folds import held_out_rows
from textjury.operators.vectors import term_vectors
from textjury.operators.voting import f1_weight, majority_vote, weighted_vote
from textjury.plans.registry import Ensemble, ModelStore, ModelVersion
from textjury.plans.split import Split, open_split, with_words

NO_WORDS = "array<string>"


def load_ensemble(store: ModelStore, algorithm: str, version: ModelVersion | None = None) -> Ensemble:
    return store.load(version or store.require(algorithm))


def load_all(store: ModelStore, algorithm: str) -> tuple[Split, Ensemble]:
    """The latest version with the split it was trained on."""
    ensemble = load_ensemble(store, algorithm)
    return open_split(store.spark, ensemble.version.split), ensemble


def predict_member(df: DataFrame, member: PipelineModel, out: str, tf: str = "tf") -> DataFrame:
    """Add the prediction ``out`` of one member, and its ``<out>_features``, to a frame with tf vectors."""
    _, idf, *selection, model = member.stages
    features = f"{out}_features"
    weighted = idf.copy({idf.inputCol: tf, idf.outputCol: features}).transform(df)
    for slicer in selection:
        kept = f"{features}_kept"
        sliced = slicer.copy({slicer.inputCol: features, slicer.outputCol: kept}).transform(weighted)
        weighted = sliced.drop(features).withColumnRenamed(kept, features)
    outputs = {model.featuresCol: features, model.predictionCol: out, model.rawPredictionCol: ""}
    if model.hasParam("probabilityCol"):
        outputs[model.probabilityCol] = ""
    return model.copy(outputs).transform(weighted)


def _member_votes(
    df: DataFrame, ensemble: Ensemble, prefix: str, tf: str
) -> tuple[DataFrame, list[str]]:
    """The k member predictions for the vectors in column ``tf``."""
    names = [f"{prefix}p{i}" for i in range(len(ensemble.members))]
    scored = df
    for name, member in zip(names, ensemble.members):
        scored = predict_member(scored, member, name, tf)
    return scored.drop(*[f"{name}_features" for name in names]), names


def score(df: DataFrame, ensemble: Ensemble) -> DataFrame:
    """Add p0..p{k-1}, ``votes`` and ``vote``. One job for any number of rows.

    The same plan serves a table and a stream: nothing in it keeps state.
    """
    tokenised = with_words(df, ensemble.version.tokenizer_settings())
    hashed = term_vectors(tokenised, ensemble.version.num_features)
    scored, names = _member_votes(hashed, ensemble, "", "tf")
    return majority_vote(scored, names).drop("words", "tf")


def predict(text: str, ensemble: Ensemble) -> int:
    """The vote on a single message, as 0 or 1. Tables and streams go through :func:`score`."""
    message = SparkSession.active().range(1, numPartitions=1).select(F.lit(text).alias("text"))
    return score(message, ensemble).select("vote").collect()[0]["vote"]


def score_weighted(df: DataFrame, ensemble: Ensemble, metrics: DataFrame) -> DataFrame:
    """Add ``vote`` with each member weighted by its F1 on the fold it never saw.

    ``metrics`` has (fold, tp, fp, fn). A member without a true positive has no weight.
    """
    counted = metrics.select("fold", f1_weight().alias("weight"))
    weights = {row["fold"]: row["weight"] for row in counted.collect()}  # k rows
    names = [f"p{i}" for i in range(len(ensemble.members))]
    scored = score(df, ensemble).drop("votes", "vote")
    return weighted_vote(scored, names, [weights[i] for i in range(len(names))])


def score_side_by_side(df: DataFrame, ensembles: Sequence[Ensemble]) -> DataFrame:
    """One column ``vote_<algorithm>`` per ensemble, all from a single scan.

    Ensembles with the same tokens share them, and the vectors if they have the
    same width.
    """
    scored = df
    helpers: list[str] = []
    for ensemble in ensembles:
        tokenizer = ensemble.version.tokenizer_settings()
        m = ensemble.version.num_features
        words = f"words_{md5(ensemble.version.tokenizer.encode()).hexdigest()}"
        tf = f"{words}_tf{m}"
        if words not in helpers:
            scored = with_words(scored, tokenizer).withColumnRenamed("words", words)
            helpers.append(words)
        if tf not in helpers:
            scored = term_vectors(scored, m, words, tf)
            helpers.append(tf)
        scored, names = _member_votes(scored, ensemble, f"{ensemble.algorithm}_", tf)
        votes = f"{ensemble.algorithm}_votes"
        scored = majority_vote(scored, names, votes, f"vote_{ensemble.algorithm}")
        helpers += [votes, *names]
    return scored.drop(*helpers)


def score_by_method(requests: DataFrame, ensembles: Sequence[Ensemble]) -> DataFrame:
    """Each request (message, method) gets the vote of the algorithm it names.

    One scan instead of one per algorithm: where an ensemble is not asked, it
    sees an empty token list, which costs next to nothing to hash and score.
    """
    scored = requests.withColumn("text", F.col("message"))
    vote = F.lit(None).cast("int")
    for ensemble in ensembles:
        asked = F.col("method") == ensemble.algorithm
        scored = _add_vote(scored, ensemble, asked)
        vote = F.when(asked, F.col(f"vote_{ensemble.algorithm}")).otherwise(vote)
    extra = [f"vote_{e.algorithm}" for e in ensembles]
    return scored.withColumn("vote", vote).drop("text", *extra)


def cascade(df: DataFrame, first: Ensemble, second: Ensemble) -> DataFrame:
    """Vote of ``first`` where its members agree, of ``second`` where they do not. Equal tokenizers cut a text once."""
    members = len(first.members)
    hashed = term_vectors(with_words(df, first.version.tokenizer_settings()), first.version.num_features)
    voted, names = _member_votes(hashed, first, "", "tf")
    settled = majority_vote(voted, names).drop("tf", *names)
    unsure = F.col("votes").between(1, members - 1)
    shared = first.version.tokenizer == second.version.tokenizer
    if not shared:
        settled = settled.drop("words")
    scored = _add_vote(settled.withColumn("unsure", unsure), second, F.col("unsure"), has_words=shared)
    other = f"vote_{second.algorithm}"
    return scored.withColumn("vote", F.when(F.col("unsure"), F.col(other)).otherwise(F.col("vote"))).drop(
        "votes", other
    )


def _add_vote(df: DataFrame, ensemble: Ensemble, asked: Column, has_words: bool = False) -> DataFrame:
    """Add ``vote_<algorithm>``; rows where ``asked`` is false are scored without their words."""
    tokenised = df if has_words else with_words(df, ensemble.version.tokenizer_settings())
    tokenised = tokenised.withColumn(
        "words", F.when(asked, F.col("words")).otherwise(F.array().cast(NO_WORDS))
    )
    hashed = term_vectors(tokenised, ensemble.version.num_features)
    prefix = f"{ensemble.algorithm}_"
    scored, names = _member_votes(hashed, ensemble, prefix, "tf")
    voted = majority_vote(scored, names, f"{prefix}votes", f"vote_{ensemble.algorithm}")
    return voted.drop("words", "tf", f"{prefix}votes", *names)


def out_of_fold(split: Split, ensemble: Ensemble, store: ModelStore) -> DataFrame:
    """(doc_id, label, fold, prediction): every row judged by the one member that never saw it.

    Each branch reads one fold folder, so the table is read once in all.
    """
    version = ensemble.version
    if version.split != split.path or version.k != split.k:
        raise RuntimeError(
            f"{version.algorithm} version {version.version} was trained on another split: "
            "its members may have seen these rows"
        )
    vectors = split.vectors(store.spark, version.num_features)
    branches = [
        predict_member(held_out_rows(vectors, fold), member, "prediction").select(
            "doc_id", "label", "fold", "prediction"
        )
        for fold, member in enumerate(ensemble.members)
    ]
    scored = branches[0]
    for branch in branches[1:]:
        scored = scored.unionByName(branch)
    return scored


def measure(scored: DataFrame, path: str | None = None) -> dict[str, float | None]:
    """Run a scoring job once; rows, seconds and seconds per message (None without rows)."""
    seen = Observation("scored")
    observed = scored.observe(seen, F.count(F.lit(1)).alias("rows"))
    started = time.perf_counter()
    if path is None:
        observed.write.format("noop").mode("overwrite").save()
    else:
        observed.write.mode("overwrite").parquet(path)
    seconds = time.perf_counter() - started
    rows = seen.get["rows"]
    return {"rows": rows, "seconds": seconds, "seconds_per_message": seconds / rows if rows else None}
