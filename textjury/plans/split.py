"""The stored split: tokenised messages in k folds, shared by all algorithms."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.operators.folds import assign_folds, check_fold_count
from textjury.operators.segmenting import segment
from textjury.operators.tokenizing import tokenize
from textjury.operators.unknown_words import place_model
from textjury.operators.vectors import term_vectors
from textjury.plans.storage import append_record, read_records

MANIFEST = "fingerprint STRING, settings STRING"
DEFAULT_TOKENIZER = {"mode": "mixed"}
BYTES_PER_FILE, BYTES_PER_TASK = 128 * 1024 * 1024, 256 * 1024 * 1024


def dictionary_tokenizer(
    vocabulary: DataFrame, path: str, lowercase: bool = False, places: DataFrame | None = None, **settings: Any
) -> dict[str, Any]:
    """Store a word list (token, optionally term_count) under ``path``; returns the tokenizer setting that uses it.

    The setting holds the list's digest, and goes with the split and with every version
    trained on it: training, scoring and streams cut with the same list, or refuse.
    ``places``, the counts of :func:`textjury.operators.unknown_words.place_counts`, are stored
    beside the list and cut what no listed word covers. ``settings`` are ``script`` and
    ``method`` of :func:`textjury.operators.segmenting.segment`.
    """
    columns = [c for c in ("token", "term_count") if c in vocabulary.columns]
    vocabulary.select(columns).write.mode("overwrite").parquet(path)
    digest = _digest(vocabulary.sparkSession.read.parquet(path))
    setting = {"mode": "dictionary", "words": path, "digest": digest, "lowercase": lowercase, **settings}
    if places is not None:
        folder = f"{path.rstrip('/')}-places"
        places.write.mode("overwrite").parquet(folder)
        stored = vocabulary.sparkSession.read.parquet(folder)
        setting |= {"places": folder, "places_digest": _digest(stored)}
    return setting


def _checked(spark: SparkSession, path: str, digest: str, what: str) -> DataFrame:
    stored = spark.read.parquet(path)
    if _digest(stored) != digest:
        raise RuntimeError(f"the {what} {path} is not the one this tokenizer was made with")
    return stored


def _digest(words: DataFrame) -> str:
    row = words.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*words.columns).cast("decimal(38,0)")).alias("hash")
    ).first()
    return f"{row['n']}:{row['hash']}"


def with_words(df: DataFrame, tokenizer: dict[str, Any]) -> DataFrame:
    """Apply a tokenizer setting.

    ``{"mode": "given"}`` takes the column ``words`` as it is; a setting of
    :func:`dictionary_tokenizer` cuts with its stored word list.
    """
    if tokenizer["mode"] == "given":
        return df.withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    if tokenizer["mode"] == "dictionary":
        settings = {k: v for k, v in tokenizer.items() if k in ("script", "method")}
        known = _checked(df.sparkSession, tokenizer["words"], tokenizer["digest"], "word list")
        if "places" in tokenizer:
            counts = _checked(df.sparkSession, tokenizer["places"], tokenizer["places_digest"], "place counts")
            settings["places"] = place_model(counts)
        if not tokenizer["lowercase"]:
            return segment(df, known, **settings)
        lowered = df.withColumn("_lowered", F.lower("text"))
        return segment(lowered, known, text="_lowered", **settings).drop("_lowered")
    return tokenize(df, **tokenizer)


def folders_at_size(df: DataFrame, k: int) -> DataFrame:
    """Fewer write tasks where each of a task's ``k`` files would be small.

    A scan task writes one file per fold. Merging tasks, without a shuffle, until a file
    holds about ``BYTES_PER_FILE`` of input keeps their number near that of the data; a task gets
    no more than about ``BYTES_PER_TASK``, as it may read that from a shuffle. The size is that
    of the files that are read: the optimizer's estimate after a join is a product.
    """
    size = scanned_bytes(df)
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // min(k * BYTES_PER_FILE, BYTES_PER_TASK)))
    return df.coalesce(int(min(wanted, 2**31 - 1)))


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables and files at the leaves of a plan, each scan counted."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


@dataclass(frozen=True)
class Split:
    path: str
    fingerprint: str
    k: int
    tokenizer: dict[str, Any]

    def rows(self, spark: SparkSession) -> DataFrame:
        """(doc_id, label, words, fold); a filter on ``fold`` prunes folders."""
        return spark.read.parquet(f"{self.path}/rows")

    def vectors(self, spark: SparkSession, num_features: int) -> DataFrame:
        """(doc_id, label, tf, fold) hashed to ``num_features`` buckets.

        Written once and read by every fold and algorithm, so a lost executor
        costs a re-read and no new tokenisation.
        """
        path = f"{self.path}/tf-{num_features}"
        if not _is_complete(spark, path, self.fingerprint):
            hashed = term_vectors(self.rows(spark), num_features)
            hashed = folders_at_size(hashed.select("doc_id", "label", "tf", "fold"), self.k)
            hashed.write.mode("overwrite").partitionBy(
                "fold"
            ).parquet(f"{path}/rows")
            _complete(spark, path, self.fingerprint, {"num_features": num_features})
        return spark.read.parquet(f"{path}/rows")

    def class_counts(self, spark: SparkSession) -> list[dict[str, Any]]:
        """Rows per fold, in total and with label 0 and 1: k rows from one narrow column."""
        counts = self.rows(spark).groupBy("fold").agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("label") == 0, 1)).alias("n_zero"),
            F.count(F.when(F.col("label") == 1, 1)).alias("n_one"),
        )
        return [row.asDict() for row in counts.collect()]


def _is_complete(spark: SparkSession, path: str, fingerprint: str) -> bool:
    done = read_records(spark, f"{path}/manifest", MANIFEST)
    return done is not None and not done.where(F.col("fingerprint") == fingerprint).isEmpty()


def _complete(spark: SparkSession, path: str, fingerprint: str, settings: dict) -> None:
    record = {"fingerprint": fingerprint, "settings": json.dumps(settings, sort_keys=True)}
    append_record(spark, f"{path}/manifest", record, MANIFEST)


def fold_settings(spark: SparkSession, path: str) -> dict[str, Any]:
    """What decides a row's words and fold in a stored split: rows that two splits with equal ones share are in one fold."""
    done = read_records(spark, f"{path}/manifest", MANIFEST)
    row = None if done is None else done.first()
    if row is None:
        raise RuntimeError(f"no complete split under {path}")
    settings = json.loads(row["settings"])
    return {name: settings[name] for name in ("k", "salt", "group_key", "tokenizer")}


def open_split(spark: SparkSession, path: str) -> Split:
    """A split stored earlier, with the settings from its manifest."""
    done = read_records(spark, f"{path}/manifest", MANIFEST)
    row = None if done is None else done.first()
    if row is None:
        raise RuntimeError(f"no complete split under {path}")
    settings = json.loads(row["settings"])
    return Split(path, row["fingerprint"], settings["k"], settings["tokenizer"])


def build_split(
    labelled: DataFrame,
    root: str,
    k: int = 5,
    salt: str = "",
    tokenizer: dict[str, Any] | None = None,
    group_key: Column | None = None,
    source_version: str | None = None,
) -> Split:
    """Tokenise (doc_id, label, text) once and store it by fold under ``root``.

    A split is found again only when its source version and every setting are
    the same and its manifest, written last, is there; anything else is built
    anew. ``source_version`` names the state of the input, for example
    :func:`textjury.plans.storage.source_state`; without it nothing is reused.
    """
    check_fold_count(k)
    spark = labelled.sparkSession
    tokenizer = tokenizer or DEFAULT_TOKENIZER
    settings = {
        "source": source_version or uuid.uuid4().hex,
        "k": k,
        "salt": salt,
        "tokenizer": tokenizer,
        "group_key": None if group_key is None else str(group_key),
    }
    fingerprint = hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()
    split = Split(f"{root}/split-{fingerprint[:16]}", fingerprint, k, tokenizer)
    if not _is_complete(spark, split.path, fingerprint):
        key = F.col("doc_id") if group_key is None else group_key
        rows = with_words(assign_folds(labelled, k, salt, key), tokenizer)
        rows = folders_at_size(rows.select("doc_id", "label", "words", "fold"), k)
        rows.write.mode("overwrite").partitionBy(
            "fold"
        ).parquet(f"{split.path}/rows")
        _complete(spark, split.path, fingerprint, settings)
    return split
