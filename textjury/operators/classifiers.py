"""The five algorithms and their training parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.linalg import Vectors

SEED = 20181116

# Fixed training parameters; what is not set here keeps Spark's default.
ALGORITHMS: dict[str, Callable[[int], object]] = {
    "LR": lambda num_features: LogisticRegression(regParam=0.2),
    "MP": lambda num_features: MultilayerPerceptronClassifier(
        layers=[num_features, 4, 3, 2], seed=SEED
    ),
    "SVM": lambda num_features: LinearSVC(regParam=0.1),
    "DT": lambda num_features: DecisionTreeClassifier(seed=SEED),
    "GBDT": lambda num_features: GBTClassifier(seed=SEED),
}
LONG_NAMES = {
    "LogisticRegression": "LR",
    "MultilayerPerceptron": "MP",
    "SupportVectorMachine": "SVM",
    "DecisionTree": "DT",
    "GradientBoostedTree": "GBDT",
}
DEFAULT_NUM_FEATURES = {"LR": 10_000, "MP": 1_000, "SVM": 10_000, "DT": 10_000, "GBDT": 10_000}


def algorithm_code(name: str) -> str:
    code = LONG_NAMES.get(name, name)
    if code not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {name!r}, use one of {sorted(ALGORITHMS)}")
    return code


def estimator(algorithm: str, num_features: int):
    return ALGORITHMS[algorithm_code(algorithm)](num_features)


#: Share of the previous weights that a warm start keeps.
SHRINK = 0.3


def warm_started(
    learner: MultilayerPerceptronClassifier, previous, shrink: float = SHRINK
) -> MultilayerPerceptronClassifier:
    """A perceptron that begins at the shrunken weights of a ``previous`` model of the same layers, not at random ones.

    Weights of a finished fit are so sure of their answers that new rows cannot move them; shrunk
    they keep the direction, and the fit can go on.
    """
    if learner.getLayers() != previous.getLayers():
        raise ValueError(f"a perceptron of layers {learner.getLayers()} cannot begin at one of {previous.getLayers()}")
    return learner.setInitialWeights(Vectors.dense(shrink * previous.weights.toArray()))


def check_classes(algorithm: str, class_counts: list[dict], left_out: Iterable[tuple[int, ...]] | None = None) -> None:
    """Refuse label sets that the algorithm cannot learn from, before any fit.

    ``class_counts`` has one entry per fold: fold, n, n_zero, n_one. ``left_out`` has the folds
    that each training set leaves out, by default one each.
    """
    total = {name: sum(c[name] for c in class_counts) for name in ("n", "n_zero", "n_one")}
    if total["n"] == 0:
        raise ValueError("no labelled messages")
    if total["n_zero"] + total["n_one"] != total["n"]:
        raise ValueError("labels must be 0 or 1")
    for folds in left_out or [(c["fold"],) for c in class_counts]:
        outside = {name: total[name] - sum(c[name] for c in class_counts if c["fold"] in folds) for name in total}
        named = f"fold {folds[0]}" if len(folds) == 1 else f"folds {folds}"
        if outside["n"] == 0:
            raise ValueError(f"all messages are in {named}: nothing left to train on")
        if algorithm == "SVM" and 0 in (outside["n_zero"], outside["n_one"]):
            raise ValueError(
                f"the messages outside {named} have one class only; "
                "the linear SVM needs both"
            )
