"""A session's tables, stored split and trained versions for one data folder.

Trainings are shared between the queries of a session: the first one that needs
an algorithm fits it, later ones find the published version.
"""

from __future__ import annotations

import hashlib
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from textjury.plans.comparison import evaluate_version
from textjury.plans.registry import Ensemble, ModelStore
from textjury.plans.scoring import load_ensemble
from textjury.plans.split import Split, build_split
from textjury.plans.storage import shared_dir, source_state
from textjury.plans.training import train_on_split
from textjury.sources.tables import at_least, labelled_messages

FOLDS = 5


class Workbench:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        run = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
        self.root = f"{run}/{hashlib.md5(self.sf_dir.encode()).hexdigest()[:8]}"
        self.store = ModelStore(spark, self.root)
        self.splits: dict[str, Split] = {}
        self.ensembles: dict[str, Ensemble] = {}
        self.evaluated: set[str] = set()
        self.folders = 0

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def documents(self) -> DataFrame:
        return at_least(self.table("documents").select("doc_id", "text"))

    def labelled(self) -> DataFrame:
        return labelled_messages(self.documents(), self.table("labels"))

    def new_folder(self, name: str) -> str:
        self.folders += 1
        return f"{self.root}/{name}-{self.folders}"

    def split(self) -> Split:
        state = source_state(self.spark, self.path("documents"), self.path("labels"))
        if state not in self.splits:
            self.splits[state] = build_split(
                self.labelled(), self.root, FOLDS, source_version=state
            )
        return self.splits[state]

    def ensemble(self, algorithm: str) -> Ensemble:
        """The published version for the current split, trained now if there is none."""
        split = self.split()
        held = self.ensembles.get(algorithm)
        if held is None or held.version.split != split.path:
            latest = self.store.latest(algorithm)
            if latest is not None and latest.split == split.path:
                held = load_ensemble(self.store, algorithm, latest)
            else:
                held = train_on_split(split, self.store, algorithm, replace=True)
            self.ensembles[algorithm] = held
        return held

    def metrics(self, algorithm: str) -> DataFrame:
        """Per-fold metrics of the current version, evaluated once and then read back."""
        ensemble = self.ensemble(algorithm)
        version = ensemble.version
        if version.path not in self.evaluated:
            evaluate_version(self.store, self.split(), ensemble)
            self.evaluated.add(version.path)
        return self.store.experiments().where(
            f"algorithm = '{version.algorithm}' and run = '{version.run}'"
        )


@cache
def _workbench(application: str, spark: SparkSession, sf_dir: str) -> Workbench:
    return Workbench(spark, sf_dir)


def workbench(spark: SparkSession, sf_dir: str) -> Workbench:
    return _workbench(spark.sparkContext.applicationId, spark, sf_dir)
