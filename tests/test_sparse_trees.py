"""Trees grown from non-zero buckets against Spark ML's own."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from textjury.operators import sparse_trees
from textjury.operators.sparse_trees import can_grow, grow, grow_tasks, thresholds
from textjury.operators.vectors import FEATURES
from textjury.plans import training
from textjury.plans.registry import ModelStore
from textjury.plans.scoring import out_of_fold
from textjury.plans.split import build_split

WIDTH, K, ROWS = 40, 3, 1_500


def _table(spark, rows):
    return spark.createDataFrame(rows, ["label", "fold", "tf"])


@pytest.fixture(scope="module")
def cells():
    """Rows with counts of up to 60, so that some buckets have more values than bins; bucket 0 is in each row, 1 in none."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(ROWS):
        held = np.unique(np.append(0, rng.choice(np.arange(2, WIDTH), 12, replace=False)))
        counts = np.where(held % 5 == 0, rng.integers(1, 60, len(held)), rng.integers(1, 4, len(held))).astype(float)
        signal = counts[held == 5].sum() / 30 + (7 in held) + counts[held == 9].sum() / 2 - (11 in held) + rng.normal()
        if i % 50 == 0:
            held, counts = held[:0], counts[:0]
        rows.append((float(signal > 0.6), i % K, SparseVector(WIDTH, held.tolist(), counts.tolist())))
    return rows


@pytest.fixture(scope="module")
def weights():
    factors = np.random.default_rng(3).uniform(0.1, 3.0, (K, WIDTH))
    factors[:, 13] = 0.0  # a bucket that every message holds
    return factors


def _spark_models(spark, cells, weights, learner):
    for i in range(K):
        scaled = [(y, SparseVector(WIDTH, v.indices, v.values * weights[i, v.indices])) for y, fold, v in cells if fold != i]
        yield learner.fit(spark.createDataFrame(scaled, ["label", FEATURES]).coalesce(1))


def _grown(spark, cells, weights, learner, tasks):
    n = np.array([sum(fold != i for _, fold, _ in cells) for i in range(K)])
    return grow(_table(spark, cells).repartition(tasks), weights, n, learner.setFeaturesCol(FEATURES), tasks)


def _shape(model):
    """Its text without the uid, numbers apart."""
    text = model.toDebugString.split("\n", 1)[1]
    number = r"-?\d+\.\d+(?:E-?\d+)?"
    return re.sub(number, "#", text), [float(x) for x in re.findall(number, text)]


@pytest.mark.parametrize("tasks", [1, 4])
def test_decision_trees_are_those_of_spark_ml(spark, cells, weights, tasks, monkeypatch):
    if tasks > 1:  # several blocks a task
        monkeypatch.setattr(sparse_trees, "CELLS_PER_BLOCK", 1_000)
    learner = DecisionTreeClassifier(seed=1)
    for got, wanted in zip(_grown(spark, cells, weights, learner, tasks), _spark_models(spark, cells, weights, learner)):
        assert got.toDebugString.split("\n", 1)[1] == wanted.toDebugString.split("\n", 1)[1]
        assert got.numNodes == wanted.numNodes > 15
        assert np.allclose(got.featureImportances.toArray(), wanted.featureImportances.toArray(), atol=1e-12)
        assert got.getMaxDepth() == 5 and got.numFeatures == WIDTH and got.numClasses == 2


def test_boosted_trees_are_those_of_spark_ml(spark, cells, weights, tasks=4):
    learner = GBTClassifier(seed=1, maxDepth=3, maxIter=4, minInstancesPerNode=40)  # in a node of few rows gains tie
    for got, wanted in zip(_grown(spark, cells, weights, learner, tasks), _spark_models(spark, cells, weights, learner)):
        assert got.treeWeights == wanted.treeWeights and got.getNumTrees == 4
        for mine, its in zip(got.trees, wanted.trees):
            (text, numbers), (its_text, its_numbers) = _shape(mine), _shape(its)
            assert text == its_text
            assert np.allclose(numbers, its_numbers, rtol=1e-9)
        assert np.allclose(got.featureImportances.toArray(), wanted.featureImportances.toArray(), atol=1e-9)


def test_one_label_or_no_words_make_leaves(spark, weights):
    empty = [(float(i % 2), i % K, SparseVector(WIDTH, [], [])) for i in range(30)]
    same = [(0.0, i % K, SparseVector(WIDTH, [i % 7], [1.0])) for i in range(30)]
    for rows, learner in ((empty, DecisionTreeClassifier()), (empty, GBTClassifier(maxIter=3)), (same, GBTClassifier(maxIter=3))):
        for model in _grown(spark, rows, weights, learner, 2):
            assert model.totalNumNodes == 3 if isinstance(learner, GBTClassifier) else model.numNodes == 1


def test_thresholds():
    assert thresholds(np.array([2.0, 4.0]), np.array([1, 1]), 3, 31).tolist() == [1.0, 3.0]
    assert thresholds(np.array([2.0, 4.0]), np.array([1, 2]), 3, 31).tolist() == [3.0]  # no row without the word
    assert thresholds(np.array([2.0]), np.array([3]), 3, 31).tolist() == []
    many = thresholds(np.arange(1.0, 101.0), np.ones(100), 100, 3)
    assert many.tolist() == [25.5, 50.5, 75.5]


def test_settings_that_are_followed():
    assert can_grow(DecisionTreeClassifier()) and can_grow(GBTClassifier())
    assert not can_grow(DecisionTreeClassifier(impurity="entropy")) and not can_grow(GBTClassifier(subsamplingRate=0.5))
    assert not can_grow(DecisionTreeClassifier(weightCol="w"))
    assert grow_tasks(1_000, 8) == 1 and grow_tasks(64_000_000, 8) == 8 and grow_tasks(10**11, 8) == 746


@pytest.mark.parametrize("algorithm", ["DT", "GBDT"])
def test_training_grows_large_tables_from_sparse_rows(spark, folder, monkeypatch, algorithm):
    """Members of a version, as stored and loaded: the same judgement of each row as Spark ML's learner gives."""
    rows = [(i, float(i % 3 == 0), " ".join(f"w{(i * j) % 61}" for j in range(1, 12)) + " bad" * (i % 3 == 0) * (i % 10 > 0)) for i in range(240)]
    split = build_split(spark.createDataFrame(rows, "doc_id LONG, label DOUBLE, text STRING"), folder, 3)
    store, judged, used = ModelStore(spark, folder), [], []
    monkeypatch.setattr(training, "grow", lambda *a, **k: used.append(1) or grow(*a, **k))
    for bound in (training.DENSE_TREE_BYTES, 0):
        monkeypatch.setattr(training, "DENSE_TREE_BYTES", bound)
        ensemble = training.train_on_split(split, store, algorithm, 500, replace=True)
        judged.append(sorted(out_of_fold(split, ensemble, store).select("doc_id", F.col("prediction")).collect()))
    assert judged[0] == judged[1] and len(judged[0]) == 240 and used == [1]
    with pytest.raises(ValueError):
        training.train_on_split(split, store, algorithm, 500, replace=True, max_dense_bytes=1_000)
