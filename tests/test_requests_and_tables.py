import pytest

from textjury.sources import tables
from textjury.sources.requests import split_valid, validate
from textjury.sources.tables import (
    at_least,
    first_messages,
    labelled_messages,
    store_by_key,
    unlabelled_messages,
)


@pytest.mark.parametrize(
    "message, method, ok",
    [
        ("x" * 50, "LR", True),
        ("x" * 51, "LR", False),
        ("  " + "x" * 50 + "　", "SVM", True),
        ("", "LR", False),
        (" \t", "LR", False),
        (None, "LR", False),
        ("hi", "KNN", False),
        ("hi", None, False),
        ("号" * 50, "GBDT", True),
    ],
)
def test_request_rules(spark, message, method, ok):
    df = spark.createDataFrame([(message, method)], "message STRING, method STRING")
    assert validate(df).first()["ok"] is ok
    accepted, rejected = split_valid(df)
    assert (accepted.count(), rejected.count()) == ((1, 0) if ok else (0, 1))


def test_labelled_and_unlabelled(spark):
    documents = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(1, 0), (3, 1), (4, None)], "doc_id LONG, toxic INT")
    got = sorted(map(tuple, labelled_messages(documents, labels).collect()))
    assert got == [(1, 0.0, "t1"), (3, 1.0, "t3")]
    assert sorted(r["doc_id"] for r in unlabelled_messages(documents, labels).collect()) == [0, 2, 4]
    assert [r["doc_id"] for r in first_messages(documents, 3).collect()] == [0, 1, 2]


def test_at_least_only_adds_partitions(spark):
    few = spark.range(10).withColumnRenamed("id", "doc_id").coalesce(1)
    assert at_least(few, 3).rdd.getNumPartitions() == 3
    many = few.repartition(6)
    assert at_least(many, 3) is many


def test_at_least_never_shuffles_a_large_table(spark, monkeypatch):
    few = spark.range(10).withColumnRenamed("id", "doc_id").coalesce(1)
    monkeypatch.setattr(tables, "SPREAD_BYTES", 79)
    assert at_least(few, 3) is few


def test_bucketed_tables_join_without_shuffle(spark, capsys):
    documents = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 50, 3)], "doc_id LONG, toxic INT")
    store_by_key(documents, "bucketed_documents", 4)
    store_by_key(labels, "bucketed_labels", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = labelled_messages(spark.table("bucketed_documents"), spark.table("bucketed_labels"))
        joined.explain()
        assert "Exchange" not in capsys.readouterr().out
        assert joined.count() == 17
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_documents")
        spark.sql("DROP TABLE bucketed_labels")


def test_at_least_bounds_what_a_task_gets(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(1000, numPartitions=1).withColumnRenamed("id", "doc_id")  # 8,000 bytes
    assert at_least(one).rdd.getNumPartitions() == cores
    monkeypatch.setattr(tables, "SPREAD_BYTES_PER_TASK", 1000)
    spread = at_least(one)
    assert spread.rdd.getNumPartitions() == 8 > cores and spread.count() == 1000
    assert at_least(one, 3).rdd.getNumPartitions() == 3
