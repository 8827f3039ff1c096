import pytest

from textjury.operators.evaluation import confusion_counts, evaluate, macro_average
from textjury.operators.voting import majority_vote, verdict, weighted_vote
from pyspark.sql import functions as F


def judged(spark, *rows):
    return spark.createDataFrame(rows, "fold INT, label DOUBLE, prediction DOUBLE")


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(1, 1), (0, 1), (1, 0), (0, 0)], (1, 1, 1, 0.5, 0.5, 0.5)),
        ([(1, 0), (0, 0)], (0, 0, 1, 1.0, 0.0, 0.0)),
        ([(0, 1), (0, 0)], (0, 1, 0, 0.0, 1.0, 0.0)),
        ([(0, 0)], (0, 0, 0, 1.0, 1.0, 1.0)),
        ([(0, 1), (1, 0)], (0, 1, 1, 0.0, 0.0, 1.0)),
        ([(1, None), (None, 1)], (0, 0, 0, 1.0, 1.0, 1.0)),
    ],
)
def test_metrics(spark, pairs, expected):
    rows = judged(spark, *[(0, None if l is None else float(l), None if p is None else float(p)) for l, p in pairs])
    row = evaluate(rows, 2).where("fold = 0").first()
    assert tuple(row[c] for c in ("tp", "fp", "fn", "precision", "recall", "f1")) == expected


def test_empty_folds_count_as_one(spark):
    metrics = evaluate(judged(spark, (0, 1.0, 0.0)), 4)
    assert metrics.count() == 4
    means = macro_average(metrics).first()
    assert (means["precision"], means["recall"], means["f1"]) == (1.0, 0.75, 0.75)


def test_mean_f1_is_the_mean_of_f1s(spark):
    metrics = evaluate(judged(spark, (0, 1.0, 1.0), (1, 1.0, 0.0), (1, 0.0, 1.0)), 2)
    means = macro_average(metrics).first()
    assert means["f1"] == 1.0 and means["precision"] == 0.5 and means["recall"] == 0.5


def test_groups_each_get_all_folds(spark):
    rows = judged(spark, (0, 1.0, 1.0), (1, 0.0, 1.0)).withColumn(
        "algorithm", F.when(F.col("fold") == 0, "a").otherwise("b")
    )
    got = {(r["algorithm"], r["fold"]): r["tp"] for r in confusion_counts(rows, 2, by=("algorithm",)).collect()}
    assert got == {("a", 0): 1, ("a", 1): 0, ("b", 0): 0, ("b", 1): 0}


def test_order_of_rows_does_not_matter(spark):
    rows = [(i % 3, float(i % 2), float(i % 5 == 0)) for i in range(90)]
    one = evaluate(judged(spark, *rows), 3).orderBy("fold").collect()
    two = evaluate(judged(spark, *reversed(rows)).repartition(5), 3).orderBy("fold").collect()
    assert one == two


@pytest.mark.parametrize("predictions, vote", [((1, 1, 0, 0), 0), ((1, 1, 1, 0), 1), ((1, 1, 1, 0, 0), 1), ((1, 1, 0, 0, 0), 0), ((1, None, 0), 0)])
def test_strict_majority(spark, predictions, vote):
    names = [f"p{i}" for i in range(len(predictions))]
    df = spark.createDataFrame([[None if p is None else float(p) for p in predictions]], ", ".join(f"{n} DOUBLE" for n in names))
    row = majority_vote(df, names).first()
    assert (row["votes"], row["vote"]) == (sum(p or 0 for p in predictions), vote)


def test_weighted_vote(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0), (0.0, 1.0, 1.0)], "a DOUBLE, b DOUBLE, c DOUBLE")
    assert [r["vote"] for r in weighted_vote(df, ["a", "b", "c"], [0.9, 0.3, 0.3]).collect()] == [1, 0]
    with pytest.raises(ValueError):
        weighted_vote(df, ["a"], [1.0, 2.0])


def test_verdict(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "vote INT")
    assert [r[0] for r in df.select(verdict(F.col("vote"))).collect()] == ["message不是垃圾短信", "message是垃圾短信", None]
