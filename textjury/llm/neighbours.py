"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample and routes every vector to a leaf. A query visits
leaves best bin first, through a priority queue over the tree's nodes; how many it visits
is widened until queries whose neighbours are known by brute force reach the recall asked
for, and a query goes on until its leaves hold as many candidates as it wants. Leaves are packed into shards of bounded size, and each shard answers the queries
that visit it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textjury.llm.common import stored

NEAREST = 20
RECALL = 0.97  # calibrated; the calibration queries are few, so more than the 0.9 asked for
#: The tree is fitted on at most so many vectors, those with the least hash of their id.
FIT_VECTORS = 20_000
#: Queries with neighbours by brute force, those with the least hash of their id that aren't queries.
CALIBRATION = 128
BRANCHES = 16
LEAF_VECTORS = 48  # of the fitted sample
ROUNDS = 8
#: Rows of a shard for each root of all rows: shards, and with them the answers to merge, grow slower than the table.
SHARD_ROWS_PER_ROOT = 36
SCORES_AT_A_TIME = 2_000_000
QUERIES_PER_GROUP = 4_096
SEED = 7


def usable(vector: Column) -> Column:
    """Not null, not zero, every component there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def packed(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector) of usable vectors, as the bytes of their doubles; only those of the commonest length.

    Of equally common lengths the smaller is taken.
    """

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            values = [np.array(v, np.float64).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], names=["vec_id", "vector"])

    good = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & usable(F.col("vector"))
    )
    lengths = good.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "size").first()
    if usual is None:
        return good.select("vec_id", F.lit(b"").alias("vector")).limit(0)
    return good.where(F.size("vector") == usual["size"]).mapInArrow(pack, "vec_id long, vector binary")


def matrix(values: list[bytes] | pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


class KMeansTree:
    """Nodes with centroids; inner ones have up to ``BRANCHES`` children, leaves a number.

    Largest inner product is nearest distance once every vector gets one more component
    that brings it to the longest vector's length, and queries get a zero there.
    """

    def __init__(self, sample: np.ndarray, longest: float):
        self.longest = longest
        self.centroids: list[np.ndarray] = [np.zeros(sample.shape[1] + 1)]
        self.children: list[list[int]] = [[]]
        self.leaf: list[int] = [-1]
        self.leaves = 0
        random = np.random.default_rng(SEED)
        waiting = [(0, self.lifted(sample))]
        while waiting:
            node, points = waiting.pop()
            groups = self._split(points, random) if len(points) > LEAF_VECTORS else []
            if len(groups) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for centre, members in groups:
                self.children[node].append(len(self.centroids))
                waiting.append((len(self.centroids), members))
                self.centroids.append(centre)
                self.children.append([])
                self.leaf.append(-1)
        self.points = np.array(self.centroids)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - np.einsum("ij,ij->i", x, x), 0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    @staticmethod
    def _split(points: np.ndarray, random: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        k = min(BRANCHES, -(-len(points) // LEAF_VECTORS))
        centres = np.unique(points[random.choice(len(points), k, replace=False)], axis=0)
        for _ in range(ROUNDS):
            nearest = (points @ centres.T - np.einsum("ij,ij->i", centres, centres) / 2).argmax(axis=1)
            used = np.unique(nearest)
            centres = np.array([points[nearest == c].mean(axis=0) for c in used])
        nearest = (points @ centres.T - np.einsum("ij,ij->i", centres, centres) / 2).argmax(axis=1)
        return [(centres[c], points[nearest == c]) for c in np.unique(nearest)]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: from the root on to the nearest child."""
        lifted, leaf = self.lifted(x), np.empty(len(x), np.int64)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, rows = waiting.pop()
            if self.leaf[node] >= 0:
                leaf[rows] = self.leaf[node]
                continue
            below = self.children[node]
            centres = self.points[below]
            nearest = (lifted[rows] @ centres.T - np.einsum("ij,ij->i", centres, centres) / 2).argmax(axis=1)
            waiting += [(below[c], rows[nearest == c]) for c in np.unique(nearest)]
        return leaf

    def visits(
        self, queries: np.ndarray, most: int, sizes: dict[int, int] | None = None, least: list[int] | None = None
    ) -> list[list[int]]:
        """The first ``most`` leaves of each query, best bin first, and on until they hold its ``least`` rows by ``sizes``."""
        flat = np.hstack([queries, np.zeros((len(queries), 1))])
        square = np.einsum("ij,ij->i", self.points, self.points)
        found = []
        for row, wanted in zip((square - 2 * flat @ self.points.T).tolist(), least or [0] * len(queries)):
            queue, leaves, held = [(row[0], 0)], [], 0
            while queue and (len(leaves) < most or held < wanted):
                _, node = heapq.heappop(queue)
                if self.leaf[node] >= 0:
                    leaves.append(self.leaf[node])
                    held += sizes.get(self.leaf[node], 0) if sizes else 0
                else:
                    for child in self.children[node]:
                        heapq.heappush(queue, (row[child], child))
            found.append(leaves)
        return found


def rebuilt(state: dict) -> KMeansTree:
    """A tree from the plain values that were sent; an executor may lack this package."""
    tree = object.__new__(KMeansTree)
    vars(tree).update(state)
    return tree


def best(scores: np.ndarray, q: np.ndarray, v: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, float]]:
    """The ``k`` largest exact inner products among rough ``scores``, ties to smaller ids; not those with id ``own``.

    All rows that rounding could place among the k largest are computed again, each in the
    same way whatever its place, so that equal vectors tie.
    """
    scores = np.where(ids == own, -np.inf, scores)
    bound = np.partition(scores, -k)[-k] if len(scores) > k else -np.inf
    at = np.flatnonzero((scores >= bound - 1e-9 * (1 + abs(bound))) & (scores > -np.inf))
    exact = (v[at] * q).sum(axis=1)
    order = np.lexsort((ids[at], -exact))[:k]
    return [(int(ids[i]), float(s)) for i, s in zip(at[order], exact[order])]


def _first(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(n)


def fit_tree(vectors: DataFrame) -> KMeansTree:
    """Fitted on at most FIT_VECTORS vectors; the length of the longest is over all."""

    def lengths(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            x = matrix(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.sqrt(np.einsum("ij,ij->i", x, x)).max(keepdims=True))], names=["n"])

    longest = vectors.select("vector").mapInArrow(lengths, "n double").agg(F.max("n")).first()[0]
    sample = matrix([bytes(r["vector"]) for r in _first(vectors, FIT_VECTORS).collect()])
    return KMeansTree(sample, longest)


def in_leaves(vectors: DataFrame, tree: KMeansTree) -> DataFrame:
    """(vec_id, vector, leaf) of every vector."""
    sent = vectors.sparkSession.sparkContext.broadcast(vars(tree))  # bounded by the fitted sample

    def route(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = rebuilt(sent.value)
        for batch in rows:
            leaf = tree.assign(matrix(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=["vec_id", "vector", "leaf"])

    return vectors.mapInArrow(route, "vec_id long, vector binary, leaf int")


def true_neighbours(placed: DataFrame, queries: list[tuple[int, bytes]], k: int) -> DataFrame:
    """(query, vec_id, leaf, score): each query's k nearest by brute force over all rows."""
    ids, x = [q for q, _ in queries], matrix([v for _, v in queries])

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            v, own = matrix(batch.column(1).to_pylist()), batch.column(0).to_numpy()
            leaf = batch.column(2).to_numpy()
            rough, out = x @ v.T, []
            for i, q in enumerate(ids):
                scores = np.where(own == q, -np.inf, rough[i])
                at = np.argpartition(scores, -k)[-k:] if len(scores) > k else np.arange(len(scores))
                out += [(i, int(own[j]), int(leaf[j]), float(scores[j])) for j in at if own[j] != q]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.float64()))],
                names=["query", "vec_id", "leaf", "score"],
            )

    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = placed.mapInArrow(scan, "query int, vec_id long, leaf int, score double")
    return found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)


def calibrate(placed: DataFrame, tree: KMeansTree, others: DataFrame, k: int, recall: float) -> int:
    """How many leaves to visit: widened until the calibration queries find that share of their true neighbours."""
    queries = [(r["vec_id"], bytes(r["vector"])) for r in _first(others, CALIBRATION).collect()]
    if not queries:
        return tree.leaves
    orders = [
        {leaf: i for i, leaf in enumerate(order)}
        for order in tree.visits(matrix([v for _, v in queries]), tree.leaves)
    ]
    reached = np.zeros(tree.leaves + 1)
    for r in true_neighbours(placed, queries, k).select("query", "leaf").collect():  # at most queries times k
        reached[orders[r["query"]][r["leaf"]] + 1] += 1
    share = np.cumsum(reached) / max(reached.sum(), 1)
    visits = 1
    while visits < tree.leaves and share[visits] < recall:
        visits += 1
    return visits


def leaf_sizes(placed: DataFrame) -> dict[int, int]:
    """Rows of each leaf that has any."""
    return {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}


def shards_of(sizes: dict[int, int], shard_rows: int) -> dict[int, tuple[int, int]]:
    """For each leaf its first shard and how many shards it is cut into. Small leaves share a shard."""
    shard, filled, found = 0, 0, {}
    for leaf in sorted(sizes):
        if filled + sizes[leaf] > shard_rows and filled:
            shard, filled = shard + 1, 0
        parts = -(-sizes[leaf] // shard_rows)
        found[leaf] = (shard, parts)
        filled += sizes[leaf]
        if parts > 1:
            shard, filled = shard + parts, 0
    return found


def query_groups(asked: DataFrame, per_group: int | None = None) -> DataFrame:
    """(shard, groups): into how many groups the queries that come to a shard are cut, by their number there."""
    per_group = per_group or QUERIES_PER_GROUP
    counted = asked.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.count("*").alias("n"))
    return counted.select("shard", F.ceil(F.col("n") / per_group).cast("int").alias("groups"))


def for_groups(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """``vectors`` of the shards that have queries, once for every group of these; other vectors go nowhere."""
    return vectors.join(groups, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")


def search(
    placed: DataFrame, tree: KMeansTree, queries: DataFrame, visits: int, k: int, shard_rows: int
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query in the leaves it visits.

    ``queries`` are all rows with a query's id; equal ones are answered once.
    """
    sizes = leaf_sizes(placed)
    home = shards_of(sizes, shard_rows)
    sent = placed.sparkSession.sparkContext.broadcast((vars(tree), home, sizes))  # bounded by the tree's leaves
    # Rows with the query's own id are no candidates, wherever they lie.
    queries = queries.groupBy("vec_id", "vector").agg(F.count("*").alias("own"))
    queries = queries.withColumn("own", F.sum("own").over(Window.partitionBy("vec_id")))

    def spread(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A vector goes to its leaf's shard, to one of them if there are several."""
        for batch in rows:
            first = [sent.value[1][leaf] for leaf in batch.column(2).to_pylist()]
            draw = batch.column(3).to_pylist()
            shard = [s + d % parts for (s, parts), d in zip(first, draw)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(shard, pa.int32())], names=["vec_id", "vector", "leaf", "shard"]
            )

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query goes to all shards that hold a leaf it visits; one row per query, with its shards."""
        tree = rebuilt(sent.value[0])
        for batch in rows:
            shards, leaves = [], []
            wanted = [k + own for own in batch.column(2).to_pylist()]
            for order in tree.visits(matrix(batch.column(1).to_pylist()), visits, sent.value[2], wanted):
                at: dict[int, list[int]] = {}
                for leaf in order:
                    shard, parts = sent.value[1].get(leaf, (0, 0))
                    for part in range(parts):
                        at.setdefault(shard + part, []).append(leaf)
                shards.append(list(at))
                leaves.append(list(at.values()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(shards, pa.list_(pa.int32())), pa.array(leaves, pa.list_(pa.list_(pa.int32())))],
                names=["query_id", "query", "shards", "leaves"],
            )

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = pa.schema([("query_id", pa.int64()), ("query", pa.binary()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        ids, leaf = right["vec_id"].to_numpy(), right["leaf"].to_numpy()
        v = matrix(right["vector"].to_pylist())
        order = np.argsort(leaf, kind="stable")
        ids, leaf, v = ids[order], leaf[order], v[order]
        held, starts = np.unique(leaf, return_index=True)
        spans = dict(zip(held.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(leaf)])))
        out = []
        size = max(1, SCORES_AT_A_TIME // len(v))
        for first in range(0, left.num_rows, size):
            block = left.slice(first, size)
            own, vectors = block["query_id"].to_pylist(), block["query"].to_pylist()
            q = matrix(vectors)
            scores = np.full((len(q), len(v)), -np.inf)
            visitors: dict[int, list[int]] = {}
            for i, leaves in enumerate(block["leaves"].to_pylist()):
                for at in leaves:
                    visitors.setdefault(at, []).append(i)
            for at, rows in visitors.items():
                if at in spans:
                    a, b = spans[at]
                    scores[rows, a:b] = q[rows] @ v[a:b].T
            for i in range(len(q)):
                out += [(own[i], vectors[i], *x) for x in best(scores[i], q[i], v, ids, own[i], k)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds) if out else kinds.empty_table()

    asked = stored(
        queries.select("vec_id", "vector", "own").mapInArrow(
            ask, "query_id long, query binary, shards array<int>, leaves array<array<int>>"
        ),
        "asked",
    )
    groups = F.broadcast(query_groups(asked))  # one row per shard
    asked = asked.select("query_id", "query", F.inline(F.arrays_zip(F.col("shards").alias("shard"), F.col("leaves"))))
    group = F.pmod(F.xxhash64("query_id", "query"), F.col("groups")).cast("int")
    vectors = placed.withColumn("draw", F.pmod(F.xxhash64("vec_id"), F.lit(2**31))).mapInArrow(
        spread, "vec_id long, vector binary, leaf int, shard int"
    )
    vectors = for_groups(vectors, groups)
    found = (
        asked.join(groups, "shard")
        .withColumn("part", group)
        .drop("groups")
        .groupBy("shard", "part")
        .cogroup(vectors.groupBy("shard", "part"))
        .applyInArrow(answer, "query_id long, query binary, vec_id long, score double")
    )
    near = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(
    table: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = NEAREST,
    recall: float = RECALL,
    shard_rows: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k nearest other rows by inner product.

    ``is_query`` is a condition on ``vec_id``. Every usable row is a candidate for every
    query but for rows with the query's own id. Scores are inner products of the original
    vectors in double precision; ties go to smaller ids. Rows whose id or vector is null,
    whose vector is zero, empty or has null or non-finite components, or another length
    than most, take no part. Repeated rows are candidates each; a repeated query row is
    answered once. Fewer than k come back only if the table has fewer candidates. Tables without
    usable rows or queries give no rows. Other columns are ignored.
    """
    vectors = stored(packed(table, key, vector), "vectors")
    if vectors.isEmpty():
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(vectors)
    placed = stored(in_leaves(vectors, tree), "leaves")
    visits = calibrate(placed, tree, vectors.where(~is_query), k, recall)
    shard_rows = shard_rows or SHARD_ROWS_PER_ROOT * math.isqrt(vectors.count())
    return search(placed, tree, vectors.where(is_query), visits, k, shard_rows)
