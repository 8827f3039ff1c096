import pytest
from pyspark.sql import functions as F

from textjury.operators.folds import (
    all_training_rows,
    assign_folds,
    fold_balance,
    held_out_rows,
    leave_one_out_counts,
    training_rows,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).cast("double").alias("label")
    )


@pytest.mark.parametrize("k", [1, 0])
def test_too_few_folds(rows, k):
    with pytest.raises(RuntimeError, match="larger than 1"):
        assign_folds(rows, k)


def test_a_row_without_key_is_an_error(spark):
    df = spark.createDataFrame([(1, 0.0), (None, 1.0)], "doc_id LONG, label DOUBLE")
    with pytest.raises(Exception, match="without a key"):
        assign_folds(df, 5).collect()


def test_all_training_rows(rows):
    split = assign_folds(rows, 4)
    got = all_training_rows(split, 4)
    for i in range(4):
        own = got.where(F.col("held_out") == i).select("doc_id")
        assert own.exceptAll(training_rows(split, i).select("doc_id")).isEmpty()
        assert own.count() == training_rows(split, i).count()


def test_disjoint_complete_and_even(rows):
    split = assign_folds(rows, 5)
    sizes = {r["fold"]: r["n"] for r in split.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert set(sizes) == set(range(5)) and sum(sizes.values()) == 2000
    assert all(320 < n < 480 for n in sizes.values())
    for i in range(5):
        assert training_rows(split, i).count() + held_out_rows(split, i).count() == 2000


def test_independent_of_partitioning_and_later_rows(spark, rows):
    first = {tuple(r) for r in assign_folds(rows, 4, "s").select("doc_id", "fold").collect()}
    more = rows.union(spark.range(5000, 6000).select("id", F.lit(0.0))).repartition(7)
    later = {tuple(r) for r in assign_folds(more, 4, "s").select("doc_id", "fold").collect()}
    assert first < later
    other = {tuple(r) for r in assign_folds(rows, 4, "t").select("doc_id", "fold").collect()}
    assert first != other


def test_equal_texts_share_a_fold(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}") for i in range(60)], "doc_id LONG, text STRING")
    split = assign_folds(df, 5, key=F.md5("text"))
    assert split.select("text", "fold").distinct().count() == 3


def test_leave_one_out_counts_with_an_empty_fold(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 0.0), (2, 1.0)], "fold INT, label DOUBLE")
    got = {tuple(r) for r in leave_one_out_counts(df, 3).collect()}
    assert got == {(0, 1, 1), (1, 3, 2), (2, 2, 1)}
    assert {tuple(r) for r in fold_balance(df).collect()} == {(0, 1.0, 1), (0, 0.0, 1), (2, 1.0, 1)}
