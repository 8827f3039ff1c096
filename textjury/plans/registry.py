"""Versioned models: k member pipelines per version, published by one registry row."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.operators.classifiers import algorithm_code
from textjury.plans.storage import append_record, claim, read_records

REGISTRY = (
    "algorithm STRING, version INT, path STRING, k INT, num_features INT, tokenizer STRING, "
    "split STRING, n_rows BIGINT, fit_seconds DOUBLE, created_at STRING"
)
EXPERIMENTS = (
    "fold INT, tp BIGINT, fp BIGINT, fn BIGINT, precision DOUBLE, recall DOUBLE, f1 DOUBLE, "
    "recorded_at TIMESTAMP, algorithm STRING, version INT, run STRING"
)


@dataclass(frozen=True)
class ModelVersion:
    algorithm: str
    version: int
    path: str
    k: int
    num_features: int
    tokenizer: str
    split: str
    n_rows: int
    fit_seconds: float
    created_at: str

    def tokenizer_settings(self) -> dict[str, Any]:
        return json.loads(self.tokenizer)

    @property
    def run(self) -> str:
        """Tells versions apart even if two trainings at once took the same number."""
        return self.path.rstrip("/").rpartition("/")[2]

    def member_path(self, fold: int) -> str:
        return f"{self.path}/member={fold}"


@dataclass(frozen=True)
class Ensemble:
    """A version with its members in memory, ready for any number of scorings."""

    version: ModelVersion
    members: tuple[PipelineModel, ...]

    @property
    def algorithm(self) -> str:
        return self.version.algorithm


class ModelStore:
    """Models under one shared folder.

    A version becomes visible with its registry row, which is written after all
    its members. Old versions stay, so a failed training changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def registry(self) -> DataFrame | None:
        return read_records(self.spark, f"{self.root}/registry", REGISTRY)

    def latest(self, algorithm: str) -> ModelVersion | None:
        rows = self.registry()
        if rows is None:
            return None
        newest = (
            rows.where(F.col("algorithm") == algorithm_code(algorithm))
            .orderBy(F.desc("version"), F.desc("created_at"))
            .first()
        )
        return None if newest is None else ModelVersion(**newest.asDict())

    def require(self, algorithm: str) -> ModelVersion:
        found = self.latest(algorithm)
        if found is None:
            raise RuntimeError(f"no trained {algorithm} model under {self.root}: train one first")
        return found

    def new_path(self, algorithm: str, version: int) -> str:
        return f"{self.root}/models/{algorithm}/v{version}-{uuid.uuid4().hex[:8]}"

    def claim_version(self, algorithm: str) -> int:
        """The next version number, taken by creating its claim: of two trainings at once, one gets n and one n + 1.

        A training that fails leaves its number unused.
        """
        newest = self.latest(algorithm)
        number = 1 if newest is None else newest.version + 1
        while not claim(self.spark, f"{self.root}/claims/{algorithm_code(algorithm)}/{number}"):
            number += 1
        return number

    def publish(self, version: ModelVersion) -> None:
        append_record(self.spark, f"{self.root}/registry", asdict(version), REGISTRY)

    def load(self, version: ModelVersion) -> Ensemble:
        """A version with its k members; a missing or unreadable one is an error."""

        def member(fold: int) -> PipelineModel:
            path = version.member_path(fold)
            try:
                return PipelineModel.load(path)
            except (PySparkException, Py4JJavaError) as cause:
                raise RuntimeError(f"cannot load model {path}") from cause

        with ThreadPoolExecutor(version.k) as pool:
            members = pool.map(inheritable_thread_target(self.spark)(member), range(version.k))
            return Ensemble(version, tuple(members))

    def record(self, version: ModelVersion, metrics: DataFrame) -> None:
        """Put the per-fold metrics of a version (k rows) into the experiment table.

        Each training has its own partition, so a repeated evaluation replaces it and
        another training's records stay, even one with the same version number.
        """
        folder = f"algorithm={version.algorithm}/version={version.version}/run={version.run}"
        names = ("fold", "tp", "fp", "fn", "precision", "recall", "f1")
        metrics.select(*names, F.current_timestamp().alias("recorded_at")).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/experiments/{folder}")

    def experiments(self) -> DataFrame:
        return self.spark.read.schema(EXPERIMENTS).parquet(f"{self.root}/experiments")
