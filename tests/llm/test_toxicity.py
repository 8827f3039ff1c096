import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textjury.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        words = [f"{draw.choice('abcdefgh')}{draw.choice('aeiou')}{draw.choice('lmnrst')}" for _ in range(draw.randint(5, 60))]
        toxic = i % 8 == 0
        if toxic:
            words += draw.choices(["vilex", "nasto", "grubo"], k=3) if i % 16 else [f"zork{draw.choice('aeiou')}{draw.choice('lmn')}" for _ in range(3)]
            draw.shuffle(words)
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark, documents, corpus):
    rows, labels = corpus
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(documents(rows), spark.createDataFrame(labels, LABELS)).collect()}
    judged = [(i % 8 == 0, scored[i] >= 0.7) for i in range(1500) if held_out(i) or i % 2]
    assert sum(t and p for t, p in judged) >= 0.97 * sum(t for t, _ in judged)
    assert sum(p and not t for t, p in judged) <= 2
    assert all(0 <= s <= 1 for s in scored.values())


def test_held_out_labels_are_not_read(spark, documents, corpus):
    rows, labels = corpus
    turned = [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels]
    table = lambda x: spark.createDataFrame(x, LABELS)
    one, other = (
        {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(documents(rows[:600]), table(x)).collect()} for x in (labels, turned)
    )
    assert one.keys() == other.keys() and all(abs(one[i] - other[i]) < 1e-6 for i in one)


def test_nulls_repeats_and_extra_columns(spark, documents, corpus):
    rows, labels = corpus
    odd = [(5000, None), (5001, ""), (None, "vilex nasto grubo"), (5002, "vilex nasto grubo"), (5002, "vilex nasto grubo"), (5003, "VILEX " * 20_000 + "nasto!!! grubo")]
    docs = documents(rows + odd).withColumns({"votes": F.lit(1), "label": F.lit(1), "score": F.lit(2), "toxic": F.lit(0)})
    known = spark.createDataFrame([*labels, (2, 1, None), (None, 1, 1), (4, 1, 0), (4, 1, 0)], LABELS)
    got = toxicity.score_toxicity(docs, known)
    assert got.count() == len(rows) + len(odd)
    scores = [(r["doc_id"], r["score"]) for r in got.where("doc_id is null or doc_id >= 5000").collect()]
    clean = {s for i, s in scores if i in (5000, 5001)}
    assert len(clean) == 1 and clean.pop() < 0.3
    assert all(s >= 0.7 for i, s in scores if i not in (5000, 5001))
    kept = toxicity.without_toxic(docs, known)
    assert kept.columns == docs.columns
    assert kept.where("doc_id is null or doc_id >= 5002").count() == 0
    assert kept.where("doc_id in (5000, 5001)").count() == 2


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(0, 1, 0), (2, 1, 0), (3, 1, 0)], 0.0), ([(1, 1, 1), (2, 1, 1), (3, 1, 1)], 1.0)])
def test_labels_of_one_kind(spark, documents, labels, score):
    docs = documents([(i, "some words") for i in range(4)])
    got = toxicity.score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert [r["score"] for r in got] == [score] * 4


def test_empty_table(spark, documents, corpus):
    empty = documents([]).limit(0)
    assert toxicity.score_toxicity(empty, spark.createDataFrame(corpus[1], LABELS)).count() == 0


def test_terms():
    assert toxicity.terms(None) == set()
    found = toxicity.terms("Abcde abcdf x1y")
    assert {"abcde", "abcdf", "x", "y", "abc*", "abc**", "abcd**"} <= found and "abc***" not in found


def test_correlated_voters_are_discounted(spark):
    """Voters 0 and 1 always fire together, voter 2 by itself."""
    patterns = [([0, 1], 1, 50), ([2], 1, 50), ([], 0, 500), ([0, 1, 2], 1, 5), ([2], 0, 3), ([0, 1], 0, 3), ([], None, 900)]
    table = spark.createDataFrame(patterns, "votes array<int>, label int, n long")
    model = toxicity.LabelModel(3)
    model.update(model.sums(table, pairs=False, labelled_only=True))
    assert model.accuracy == pytest.approx([55.5 / 59, 55.5 / 59, 55.5 / 59])
    model.correlate(model.sums(table, pairs=True, labelled_only=False))
    assert model.crowding[0] == pytest.approx(2, abs=0.01) and model.crowding[2] == pytest.approx(1, abs=0.01)
    p = model.posterior(np.array([[1, 1, 0], [0, 0, 1], [0, 0, 0]], np.float32))
    assert p[0] == pytest.approx(p[1], abs=0.02) and p[2] < 0.01
