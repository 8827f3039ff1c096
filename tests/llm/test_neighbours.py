import numpy as np
import pytest
from pyspark.sql import functions as F

from textjury.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in enumerate(vectors)], SCHEMA)


def brute(rows, is_query, k=20):
    """Rows are (id, vector) that take part."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i, v in zip(ids, x):
        if is_query(i):
            scores = (x * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), scores[j]) for j in order]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(got, expected):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in near}) for q, near in expected.items()) / sum(map(len, expected.values()))


@pytest.mark.parametrize("shard_rows", [None, 150])
def test_recall_on_unit_vectors(spark, shard_rows):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = result(neighbours.nearest(table(spark, x), F.col("vec_id") % 20 == 0, shard_rows=shard_rows))
    expected = brute(list(enumerate(x)), lambda i: i % 20 == 0)
    assert recall(got, expected) >= 0.9
    exact = {(q, i): s for q, near in brute(list(enumerate(x)), lambda i: i % 20 == 0, 3000).items() for i, s in near}
    assert all(s == pytest.approx(exact[q, i], abs=1e-12) for q, near in got.items() for i, s in near)


def test_recall_with_lengths_and_clusters(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(40, 16))[draw.integers(0, 40, 3000)] + 0.2 * draw.normal(size=(3000, 16))
    x *= draw.uniform(0.2, 3, size=(3000, 1))
    got = result(neighbours.nearest(table(spark, x), F.col("vec_id") % 20 == 0))
    assert recall(got, brute(list(enumerate(x)), lambda i: i % 20 == 0)) >= 0.9


def test_few_leaves_are_visited_in_clusters(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(30, 16))[draw.integers(0, 30, 3000)] + 0.01 * draw.normal(size=(3000, 16))
    vectors = neighbours.packed(table(spark, x / np.linalg.norm(x, axis=1, keepdims=True)), "vec_id", "embedding")
    tree = neighbours.fit_tree(vectors)
    placed = neighbours.in_leaves(vectors, tree)
    visits = neighbours.calibrate(placed, tree, vectors.where("vec_id % 20 <> 0"), 20, 0.97)
    assert tree.leaves > 30 and visits < tree.leaves / 3


def test_ties_among_many_copies(spark):
    """A third of all rows is one vector: equal scores, so the smallest ids are asked for."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(1500, 8))
    x[::3] = x[0] * 4
    got = result(neighbours.nearest(table(spark, x), F.col("vec_id") % 300 == 0, shard_rows=100))
    expected = brute(list(enumerate(x)), lambda i: i % 300 == 0)
    assert [i for i, _ in got[300]] == [i for i, _ in expected[300]] == [3 * i for i in range(20)]
    assert [i for i, _ in got[0]] == [3 * i for i in range(1, 21)]


def test_rows_that_take_no_part(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.5]]
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    rows = table(spark, good + bad, first=20).unionByName(spark.createDataFrame([(None, [9.0, 9.0], 0)], SCHEMA))
    rows = rows.withColumns({"vector": F.lit("x"), "leaf": F.lit(1), "rank": F.lit(2)})
    got = result(neighbours.nearest(rows, F.col("vec_id") % 20 == 0))
    assert got == {20: [(21, 4.0), (22, 1.5)]}


def test_repeated_rows_are_candidates_each(spark):
    rows = table(spark, [[1.0, 0.0], [0.5, 0.5]], first=20)
    got = neighbours.nearest(rows.unionByName(rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(20, 1, 21), (20, 2, 21)]


def test_empty(spark):
    empty = table(spark, [[1.0, 2.0]]).limit(0)
    assert neighbours.nearest(empty, F.col("vec_id") % 20 == 0).collect() == []
    assert neighbours.nearest(table(spark, [[1.0, 2.0], [1.0, 1.0]], first=1), F.col("vec_id") % 20 == 0).collect() == []


def test_small_leaves_are_not_the_end(spark):
    """Leaves of a few outliers: a query there goes on until it has its 20, copies of its own row not counted."""
    draw = np.random.default_rng(5)
    far = 40 * np.repeat(draw.normal(size=(8, 8)), 5, axis=0)
    x = np.vstack([draw.normal(size=(1160, 8)) * 0.01 + 1, far + 0.01 * draw.normal(size=(40, 8))])
    rows = table(spark, x)
    repeated = rows.unionByName(table(spark, [x[1180]] * 30).withColumn("vec_id", F.lit(1180).cast("long")))
    vectors = neighbours.packed(repeated, "vec_id", "embedding")
    tree = neighbours.fit_tree(vectors)
    placed = neighbours.in_leaves(vectors, tree)
    assert min(neighbours.leaf_sizes(placed).values()) < 20
    found = neighbours.search(placed, tree, vectors.where("vec_id % 20 = 0"), 1, 20, 400)
    counts = {r["query_id"]: r["count"] for r in found.groupBy("query_id").count().collect()}
    assert counts == {i: 20 for i in range(0, 1200, 20)}
    few = neighbours.nearest(rows.where("vec_id < 15 or vec_id = 1180"), F.col("vec_id") % 20 == 0)
    assert few.count() == 2 * 15


def test_only_vectors_of_hot_shards_are_repeated(spark, monkeypatch):
    """Shuffled vector rows stay below (1 + share of hot shards) times all; the answers do not change."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8)) * 20
    rows = np.concatenate([c + rng.normal(size=(100, 8)) for c in centres])
    df = table(spark, rows)
    expected = result(neighbours.nearest(df, F.col("vec_id") % 4 == 0, k=5, shard_rows=100))
    monkeypatch.setattr(neighbours, "QUERIES_PER_GROUP", 40)
    sent, old = [], neighbours.for_groups

    def counted(vectors, groups):
        repeated = old(vectors, groups)
        hot = groups.where("groups > 1").count() / groups.count()
        sent.append((repeated.count(), len(rows), hot, groups.agg(F.max("groups")).first()[0]))
        return repeated

    monkeypatch.setattr(neighbours, "for_groups", counted)
    assert result(neighbours.nearest(df, F.col("vec_id") % 4 == 0, k=5, shard_rows=100)) == expected
    (repeated, n, hot, most) = sent[0]
    assert most >= 1 and repeated <= (1 + hot * (most - 1)) * n + 100
