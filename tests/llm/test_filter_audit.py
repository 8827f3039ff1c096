import random
from itertools import permutations

import duckdb
import numpy as np
import pytest

from textjury.llm.filter_audit import AUDIT_SQL, common, filter_interactions, set_sizes, union

LABELS = "doc_id long, quality int, toxic int"


def by_sql(docs, labels):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    connection.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    for name, rows in (("documents", docs), ("labels", labels)):
        if rows:
            connection.executemany(f"INSERT INTO {name} VALUES (?, ?, ?)", [list(r) for r in rows])
    return sorted(map(repr, connection.sql(AUDIT_SQL).fetchall()))


def found(spark, docs, labels):
    columns = "doc_id long, text string, source string, bits int, part string, first string, marks int, weight int"
    df = spark.createDataFrame([(*d, 1, "p", "f", 2, 3) for d in docs], columns)
    return sorted(repr(tuple(r)) for r in filter_interactions(df, spark.createDataFrame(labels, LABELS)).collect())


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.3:
            text = rng.choice(docs)[1]
        else:
            text = " ".join(rng.choice(words[: rng.choice([20, 200])]) for _ in range(rng.randint(0, 120)))
            text = text.upper() if rng.random() < 0.2 else text
            text += rng.choice(["", "", " #"])
        docs.append((i, text, rng.choice(["a", "a", "b", None])))
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n, 2)]
    return docs, labels


def test_equals_sql(spark):
    docs, labels = corpus(1)
    assert found(spark, docs, labels) == by_sql(docs, labels)


def test_steps_add_up(spark):
    docs, labels = corpus(2, 150)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = filter_interactions(df, spark.createDataFrame(labels, LABELS)).collect()
    parts = {d[2] or "" for d in docs}
    assert {(r["part"], r["filter_order"], r["step"]) for r in rows} == {
        (p, "".join(o), s) for p in parts for o in permutations("ABCDE") for s in range(1, 6)
    }
    for part in parts:
        one = sorted((r["step"], r["kept"], r["removed"]) for r in rows if (r["part"], r["filter_order"]) == (part, "CADBE"))
        left = sum((d[2] or "") == part for d in docs)
        for _, kept, removed in one:
            assert kept == left - removed
            left = kept
        assert sum({r["filter_order"][r["step"] - 1]: r["shapley"] for r in rows if r["part"] == part}.values()) == 120 * (
            sum((d[2] or "") == part for d in docs) - left
        )


def test_nulls_repeated_rows_and_empty_texts(spark):
    docs = [
        (1, None, None), (1, None, None), (2, "", ""), (None, "", "a"), (None, None, "a"), (3, "x" * 100_000, "a"), (4, "x" * 100_000, "a"),
        (4, "x" * 100_000, "b"), (5, "A B C", "b"), (-1, "x" * 100_000, "c"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (4, None, 1), (4, 1, None), (99, 1, 1)]
    assert found(spark, docs, labels) == by_sql(docs, labels)


def test_hot_id_and_hot_text(spark):
    docs = [(7, f"t{i}", "a") for i in range(200)] + [(i, "same", "a") for i in range(200)] + [(None, "same", "b")] * 100
    labels = [(7, 1, 1)]
    assert found(spark, docs, labels) == by_sql(docs, labels)


def test_empty(spark):
    assert found(spark, [], []) == []


@pytest.mark.parametrize("seed", range(4))
def test_merges(seed):
    rng = np.random.default_rng(seed)
    lists = [np.flatnonzero(rng.random(3000) < p) for p in (0.5, 0.01, 0.2, 0.0, 0.9)]
    for one in lists:
        for other in lists:
            assert union(one, other).tolist() == sorted(set(one) | set(other))
            assert common(one, other) == len(set(one) & set(other))
    for subset, n, good, toxic in set_sizes(lists, lists[0], lists[3]):
        members = set().union(*[lists[f] for f in range(5) if subset >> f & 1])
        assert (n, good, toxic) == (len(members), len(members & set(lists[0])), 0)
