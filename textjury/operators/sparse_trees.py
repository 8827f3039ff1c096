"""Decision trees and boosted trees of all k training sets, grown from the non-zero buckets of a message.

Spark ML's learner keeps a dense row of bins per message and visits each bucket of each row at each level,
10,000 where 300 are not zero, once per training set. This one grows the same trees: same thresholds, gains,
order of ties, stopping rules, pruning and boosting, so what comes out are Spark ML's own models. It keeps the non-zero
cells only, sorted by bucket and count, and takes a level of all k training sets in one pass: a bucket's
rows without the word are the node's rows less those with it.

Thresholds come from the counts of all rows, where Spark ML takes a sample of some 10,000; on tables of up to so many rows
they are the same.
"""

from __future__ import annotations

import gc
import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.operators.vectors import TF

#: A block's rows are numbered in 16 bits; its cells are sorted in one task's memory.
ROWS_PER_BLOCK, CELLS_PER_BLOCK = 65_536, 2_000_000
EPSILON = 2.0**-52
#: Stored bytes of a cell, and how many of them a task should hold at most.
CELL_BYTES, BYTES_PER_TASK = 2, 256 * 1024 * 1024
#: Cells below which one more task costs more than it saves.
CELLS_PER_TASK = 500_000
DEEPEST = 10


def can_grow(learner: Any) -> bool:
    """Whether the learner's settings are those that are followed here."""
    plain = learner.getMaxDepth() <= DEEPEST and learner.getMinWeightFractionPerNode() == 0 and not learner.isSet("weightCol")
    if not learner.hasParam("subsamplingRate"):
        return plain and learner.getImpurity() == "gini"
    whole = learner.getSubsamplingRate() == 1.0 and learner.getFeatureSubsetStrategy() == "all"
    return plain and whole and not learner.isSet("validationIndicatorCol")


def grow_tasks(entries: int, cores: int) -> int:
    """Tasks of a pass: no more than cores, unless one would hold too much."""
    return max(1, min(cores, entries // CELLS_PER_TASK), -(-entries * CELL_BYTES // BYTES_PER_TASK))


# Blocks: the cells of some rows, sorted by bucket and count; equal ones are a run


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches (label, fold, indices, values) as pickled blocks of bounded size."""
    held, n_rows, n_cells = [], 0, 0
    for batch in batches:
        lengths = batch.column(2).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths), 0
        while at < len(lengths):
            before = ends[at - 1] if at else 0
            most = int(np.searchsorted(ends, before + CELLS_PER_BLOCK - n_cells, "right"))
            end = min(max(most, at if held else at + 1), at + ROWS_PER_BLOCK - n_rows)
            if end > at:
                held.append(batch.slice(at, end - at))
                n_rows, n_cells, at = n_rows + end - at, n_cells + int(ends[end - 1] - before), end
            if at < len(lengths):
                yield _binary(_block(held))
                held, n_rows, n_cells = [], 0, 0
    if held:
        yield _binary(_block(held))


def _binary(block: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary())], ["block"])


def _block(batches: list[pa.RecordBatch]) -> tuple:
    label = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in batches])
    fold = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in batches])
    lengths = np.concatenate([b.column(2).value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for b in batches])
    bucket = np.concatenate([b.column(2).flatten().to_numpy(zero_copy_only=False) for b in batches])
    count = np.concatenate([b.column(3).flatten().to_numpy(zero_copy_only=False) for b in batches])
    row = np.repeat(np.arange(len(label), dtype=np.uint16), lengths)
    order = np.lexsort((count, bucket))
    bucket, count, row = bucket[order], count[order], row[order]
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (count[1:] != count[:-1])
    first = np.flatnonzero(new)
    return label, fold, bucket[first], count[first], np.append(first, len(bucket)), row


def _reduced(pieces: RDD, partitions: int, finish: Callable[[Iterator], Iterable]) -> RDD:
    """``finish`` sees all pieces of its keys; a single task keeps its own."""
    if partitions > 1:
        pieces = pieces.partitionBy(partitions, lambda key: key)
    return pieces.mapPartitions(finish)


# Thresholds


def thresholds(values: np.ndarray, counts: np.ndarray, n_rows: int, most: int) -> np.ndarray:
    """Spark ML's thresholds of a feature from its sorted non-zero values: all midpoints, or ``most`` by rank."""
    zeros = n_rows - counts.sum()
    if zeros > 0:
        values, counts = np.append(0.0, values), np.append(zeros, counts)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride, chosen, seen = n_rows / (most + 1), [], counts[0]
    target = stride
    for i, count in enumerate(counts[1:]):
        before, seen = seen, seen + count
        if abs(before - target) < abs(seen - target):
            chosen.append(i)
            target += stride
    return middles[chosen]


def _bins(blocks: RDD, weights: np.ndarray, n_rows: np.ndarray, max_bins: int, tasks: int) -> tuple:
    """(slots before each bucket, thresholds in bucket order) of each training set; both bounded by buckets and bins."""
    k, width = weights.shape
    step = -(-width // tasks)
    most = [int(min(max_bins, n)) - 1 for n in n_rows]

    def counted(stored: Iterator[bytes]) -> Iterator[tuple]:
        for _, fold, bucket, count, starts, row in map(pickle.loads, stored):
            run = np.repeat(np.arange(len(bucket)), np.diff(starts))
            by_fold = np.bincount(run * k + fold[row], minlength=len(bucket) * k).reshape(-1, k)
            cuts = np.searchsorted(bucket, np.arange(tasks + 1) * step)
            for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    yield part, (bucket[a:b], count[a:b], by_fold[a:b])

    def cut(pieces: Iterator[tuple]) -> Iterator[tuple]:
        held = [piece for _, piece in pieces]
        if not held:
            return
        bucket, count, by_fold = (np.concatenate(parts) for parts in zip(*held))
        order = np.lexsort((count, bucket))
        bucket, count, by_fold = bucket[order], count[order], by_fold[order]
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (count[1:] != count[:-1]))
        first = np.flatnonzero(new)
        bucket, count, by_fold = bucket[first], count[first], np.add.reduceat(by_fold, first)
        ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
        training = by_fold.sum(axis=1, keepdims=True) - by_fold
        a = 0
        for b in ends.tolist():
            values = weights[:, bucket[a], None] * count[None, a:b]
            for i in range(k):
                there = (training[a:b, i] > 0) & (values[i] != 0)
                if there.any():
                    found = thresholds(values[i][there], training[a:b, i][there], n_rows[i], most[i])
                    if len(found):
                        yield i, int(bucket[a]), found
            a = b

    sizes, by_bucket = np.ones((k, width), np.int64), [{} for _ in range(k)]
    for i, number, found in _reduced(blocks.mapPartitions(counted), tasks, cut).collect():
        sizes[i, number] = len(found) + 1
        by_bucket[i][number] = found
    before = np.concatenate([np.zeros((k, 1), np.int64), np.cumsum(sizes, axis=1)], axis=1)
    flat = [np.concatenate([t[b] for b in sorted(t)] or [np.zeros(0)]) for t in by_bucket]
    return before, flat


def _binned(blocks: RDD, weights: np.ndarray, before: np.ndarray, flat: list[np.ndarray]) -> RDD:
    """Blocks in which a run has, for each training set, its slot: slots before its bucket plus its bin."""
    sent = blocks.context.broadcast((weights, before, flat))

    def with_slots(stored: bytes) -> bytes:
        factor, offsets, every = sent.value
        label, fold, bucket, count, starts, row = pickle.loads(stored)
        margins = np.zeros((len(factor), len(label)))
        slots = np.empty((len(factor), len(bucket)), np.int32)
        for i in range(len(factor)):
            value = factor[i, bucket] * count
            size = offsets[i, bucket + 1] - offsets[i, bucket] - 1
            at = offsets[i, bucket] - bucket  # thresholds before this bucket
            bins = np.zeros(len(bucket), np.int64)
            for j in range(int(size.max(initial=0))):
                some = np.flatnonzero(size > j)
                bins[some] += every[i][at[some] + j] < value[some]
            slots[i] = offsets[i, bucket] + bins
        return pickle.dumps((label, margins, fold, slots, starts, row), 5)

    return blocks.map(with_slots)


# Rows in trees: a node is (its number in the heap, first and last slot of the cells that go right)


def routed(block: tuple, held_out: int, splits: np.ndarray) -> np.ndarray:
    """The node each row is in; 0 for rows of the fold that is left out."""
    _, _, fold, slots, starts, row = block
    at = (fold != held_out).astype(np.int64)
    deepest = int(splits[:, 0].max(initial=0))
    for level in range(deepest.bit_length()):
        here = splits[(splits[:, 0] >> level) == 1]
        table = np.arange(2 * deepest + 2)
        table[here[:, 0]] *= 2
        after = table[at]
        first = starts[np.searchsorted(slots[held_out], here[:, 1], "left")]
        last = starts[np.searchsorted(slots[held_out], here[:, 2], "right")]
        for node, a, b in zip(here[:, 0].tolist(), first.tolist(), last.tolist()):
            with_word = row[a:b]
            after[with_word[at[with_word] == node]] = 2 * node + 1
        at = after
    return at


def target(label: np.ndarray, margin: np.ndarray, number: int, boosted: bool) -> np.ndarray:
    """What tree ``number`` is fitted to: the label, or its sign, then the negative gradient of the log loss."""
    if not boosted:
        return label
    sign = 2 * label - 1
    with np.errstate(over="ignore"):
        return 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin)) if number else sign


def _advanced(binned: RDD, trees: list[tuple]) -> RDD:
    """Blocks whose margins include one more tree of each training set."""

    def add(stored: bytes) -> bytes:
        block = pickle.loads(stored)
        for i, (splits, values, weight) in enumerate(trees):
            block[1][i] += weight * values[routed(block, i, splits)]
        return pickle.dumps(block, 5)

    return binned.map(add)


def _node_sums(node: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Rows, sum and sum of squares per node."""
    weighed = (None, value, value * value)
    return np.stack([np.bincount(node, weights=w, minlength=n)[:n] for w in weighed], axis=1).astype(float)


def _level(
    binned: RDD, number: int, current: list[np.ndarray], frontier: list[list[int]], boosted: bool, least: int, tasks: int, sent: Any
) -> dict:
    """For each node of ``frontier`` its sums and its best split (gain, slot, rows and sum on its right)."""
    active = [i for i, nodes in enumerate(frontier) if nodes]

    def cuts_of(offsets: np.ndarray) -> np.ndarray:
        """Slots at which the parts begin, none inside a bucket."""
        even = np.linspace(0, offsets[-1], tasks + 1).astype(np.int64)
        return offsets[np.searchsorted(offsets, even)]

    def histograms(stored: Iterator[bytes]) -> Iterator[tuple]:
        held = {}
        for i in active:
            size = int(sent.value[i, -1]), len(frontier[i])
            held[i] = np.zeros((size[1], 3)), np.zeros(size, np.int32), np.zeros(size)
        for label, margins, fold, slots, starts, row in map(pickle.loads, stored):
            lengths, row = np.diff(starts), row.astype(np.intp)
            run = np.repeat(np.arange(len(lengths)), lengths)
            for i in active:
                totals, counts, sums = held[i]
                nodes, slot = np.array(frontier[i]), slots[i]
                m = len(nodes)
                value = target(label, margins[i], number, boosted)
                at = routed((label, margins, fold, slots, starts, row), i, current[i])
                place = np.full(int(max(at.max(initial=0), nodes.max())) + 1, m)
                place[nodes] = np.arange(m)
                local = place[at]
                totals += _node_sums(local, value, m + 1)[:m]
                if not len(row):
                    continue
                new = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
                if m == 1:  # each run is one cell of the histogram
                    there = local == 0
                    first = starts[new]
                    counts[slot[new], 0] += np.add.reduceat(there.astype(np.int32)[row], first)
                    sums[slot[new], 0] += np.add.reduceat(np.where(there, value, 0.0)[row], first)
                    continue
                key = run * (m + 1)
                key += local[row]
                for into, weighed in ((counts, None), (sums, value[row])):
                    by_run = np.bincount(key, weights=weighed, minlength=len(slot) * (m + 1)).reshape(-1, m + 1)[:, :m]
                    into[slot[new]] += np.add.reduceat(by_run, new).astype(into.dtype, copy=False)
        for i, (totals, counts, sums) in held.items():
            cuts = cuts_of(sent.value[i])
            for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
                there = np.flatnonzero(counts[a:b])  # small nodes have few words
                yield part, (i, totals, there.astype(np.int32), counts[a:b].flat[there], sums[a:b].flat[there])

    def best(pieces: Iterator[tuple]) -> Iterator[tuple]:
        held: dict = {}
        for part, (i, totals, there, counts, sums) in pieces:
            if (i, part) not in held:
                cuts, m = cuts_of(sent.value[i]), len(totals)
                size = int(cuts[part + 1] - cuts[part])
                held[i, part] = (np.zeros((m, 3)), np.zeros((size, m)), np.zeros((size, m)))
            have = held[i, part]
            have[0][:] += totals
            have[1].reshape(-1)[there] += counts
            have[2].reshape(-1)[there] += sums
        for (i, part), (totals, counts, sums) in held.items():
            offsets = sent.value[i]
            cuts = cuts_of(offsets)
            inside = offsets[(offsets >= cuts[part]) & (offsets < cuts[part + 1])]
            sizes = np.diff(np.append(inside, cuts[part + 1]))
            inside = inside - cuts[part]
            for j in range(int(sizes.max(initial=0)) - 2, 0, -1):  # rows with this count or more
                more = inside[sizes > j + 1] + j
                counts[more] += counts[more + 1]
                sums[more] += sums[more + 1]
            split = np.ones(len(counts), bool)
            split[inside] = False
            slots = np.flatnonzero(split)
            if not len(slots):
                yield i, part, totals, None
                continue
            right, right_sum = counts[slots], sums[slots]
            gain = gains(totals, right, right_sum, boosted, number == 0, least)
            top = np.argmax(gain, axis=0)
            m = np.arange(len(totals))
            yield i, part, totals, (gain[top, m], slots[top] + cuts[part], right[top, m], right_sum[top, m])

    found: dict = {}
    pieces = binned.mapPartitions(histograms)
    for i, _, totals, splits in sorted(_reduced(pieces, tasks, best).collect(), key=lambda r: r[:2]):
        for j, node in enumerate(frontier[i]):
            have = found.setdefault((i, node), [totals[j], (-np.inf, 0, 0, 0.0)])
            if splits is not None and splits[0][j] > have[1][0]:
                have[1] = tuple(column[j] for column in splits)
    return found


def impurity(n: Any, s: Any, squares: Any, boosted: bool) -> Any:
    """Variance of the targets, or Gini impurity of labels 0 and 1."""
    if boosted:
        return (squares - s * s / n) / n
    zero, one = (n - s) / n, s / n
    return 1.0 - zero * zero - one * one


def gains(
    totals: np.ndarray, right: np.ndarray, right_sum: np.ndarray, boosted: bool, signs: bool, least: int
) -> np.ndarray:
    """Gain of each split (a row) in each node (a column); minus infinity where a side has fewer than ``least`` rows."""
    n, s, squares = totals.T
    left, left_sum = n - right, s - right_sum
    with np.errstate(divide="ignore", invalid="ignore"):
        if boosted and not signs:  # the squares cancel out
            gain = (left_sum * left_sum / left + right_sum * right_sum / right - s * s / n) / n
        else:  # labels and signs: the squares are the ones, or as many as the rows
            sides = impurity(left, left_sum, left, boosted), impurity(right, right_sum, right, boosted)
            gain = impurity(n, s, squares, boosted) - (left / n) * sides[0] - (right / n) * sides[1]
    return np.where((left >= least) & (right >= least) & ~np.isnan(gain), gain, -np.inf)


def grow(
    rows: DataFrame, weights: np.ndarray, n_rows: np.ndarray, learner: Any, tasks: int
) -> list[DecisionTreeClassificationModel | GBTClassificationModel]:
    """The model of each training set i: all ``rows`` (label, fold, tf) outside fold i, counts times ``weights[i]``.

    ``n_rows`` has the rows of each training set. ``rows`` should be in ``tasks`` partitions. The
    driver holds trees and thresholds; a task holds a block of cells and the sums of all open nodes.
    """
    spark = rows.sparkSession
    boosted = learner.hasParam("subsamplingRate")
    tf = F.unwrap_udt(TF)
    cells = rows.select(
        F.col("label").cast("double"), F.col("fold").cast("int"), tf["indices"].alias("buckets"), tf["values"].alias("counts")
    )
    blocks = cells.mapInArrow(packed, "block BINARY").rdd.map(lambda r: bytes(r[0]))
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    before, flat = _bins(blocks, weights, n_rows, learner.getMaxBins(), tasks)
    binned = _binned(blocks, weights, before, flat).persist(StorageLevel.MEMORY_AND_DISK)
    sent = spark.sparkContext.broadcast(before)
    k, deepest, least = len(weights), learner.getMaxDepth(), learner.getMinInstancesPerNode()
    rounds = learner.getMaxIter() if boosted else 1
    trees: list[list[tuple]] = [[] for _ in range(k)]
    gained: list[list[dict]] = [[] for _ in range(k)]

    def value(n: float, s: float) -> float:
        return s / n if boosted else float(s > n - s)

    earlier = blocks
    for number in range(rounds):
        if number:
            earlier, binned = binned, _advanced(binned, [t[-1] for t in trees]).persist(StorageLevel.MEMORY_AND_DISK)
            _forget_shuffles(spark)
        current = [np.zeros((0, 3), np.int64) for _ in range(k)]
        values = [np.zeros(2 << deepest) for _ in range(k)]
        gain_of: list[dict] = [{} for _ in range(k)]
        frontier = [[1] for _ in range(k)]
        for level in range(max(deepest, 1)):
            found = _level(binned, number, current, frontier, boosted, least, tasks, sent)
            if level == 0:
                earlier.unpersist()  # read by now
            frontier = [[] for _ in range(k)]
            for (i, node), ((n, s, squares), (gain, slot, right, right_sum)) in sorted(found.items()):
                values[i][node] = value(n, s) if n else 0.0
                pure = n == 0 or abs(impurity(n, s, squares, boosted)) < EPSILON
                if deepest == 0 or pure or not gain > 0 or gain < learner.getMinInfoGain():
                    continue
                bucket = int(np.searchsorted(before[i], slot, "right")) - 1
                split = (node, int(slot), int(before[i, bucket + 1]) - 1)
                current[i] = np.vstack([current[i], split])
                gain_of[i][node] = (float(gain), bucket, float(flat[i][int(slot) - bucket - 1]))
                values[i][2 * node] = value(n - right, s - right_sum)
                values[i][2 * node + 1] = value(right, right_sum)
                if level + 1 < deepest:
                    frontier[i] += [2 * node, 2 * node + 1]
            if not any(frontier):
                break
        for i in range(k):
            weight = learner.getStepSize() if number else 1.0
            trees[i].append((current[i], values[i], weight))
            gained[i].append(gain_of[i])

    def sums(stored: Iterator[bytes]) -> Iterator[np.ndarray]:
        every = np.zeros((k, rounds, 2 << deepest, 3))
        for block in map(pickle.loads, stored):
            for i in range(k):
                margin = np.zeros(len(block[0]))
                for t, (splits, values, weight) in enumerate(trees[i]):
                    at = routed(block, i, splits)
                    every[i, t] += _node_sums(at, target(block[0], margin, t, boosted), 2 << deepest)
                    margin += weight * values[at]
        yield every

    leaves = binned.mapPartitions(sums).treeReduce(np.add)
    binned.unpersist()
    return [_model(spark, learner, weights.shape[1], trees[i], gained[i], leaves[i], boosted) for i in range(k)]


def _forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of passes that are over: it does when their tables are collected as garbage."""
    gc.collect()
    spark._jvm.System.gc()


# Spark ML's models from trees


def _model(
    spark: SparkSession, learner: Any, width: int, trees: list[tuple], gained: list[dict], leaves: np.ndarray, boosted: bool
) -> DecisionTreeClassificationModel | GBTClassificationModel:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml, kind = jvm.org.apache.spark.ml, "variance" if boosted else "gini"
    # looking a class up takes several calls of the JVM, so it is done once
    leaf, inner, cut = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    calculator = jvm.org.apache.spark.mllib.tree.impurity.ImpurityCalculator.getCalculator
    slice_of = jvm.java.util.Arrays.copyOfRange

    def doubles(values: Iterable[float]) -> Any:
        raw = np.array(list(values), ">f8")
        array = gateway.new_array(jvm.double, len(raw))
        jvm.java.nio.ByteBuffer.wrap(raw.tobytes()).asDoubleBuffer().get(array)
        return array

    def node(tree: int, number: int) -> tuple:
        """(Java node, its prediction if it is a leaf)."""
        n, s, squares = (float(x) for x in sums[tree, number])
        said, at = float(trees[tree][1][number]), (tree * sums.shape[1] + number) * size
        spoiled, stats = float(impurity(n, s, squares, boosted)) if n else 0.0, calculator(kind, slice_of(kept, at, at + size), int(n))
        if number in gained[tree]:
            (left, one), (right, other) = node(tree, 2 * number), node(tree, 2 * number + 1)
            if one is None or one != other:
                gain, bucket, threshold = gained[tree][number]
                return inner(said, spoiled, gain, left, right, cut(bucket, threshold), stats), None
        return leaf(said, spoiled, stats), said

    sums = leaves.copy()
    for tree, gain_of in enumerate(gained):
        for number in sorted(gain_of, reverse=True):
            sums[tree, number] = sums[tree, 2 * number] + sums[tree, 2 * number + 1]
    stored = sums if boosted else np.stack([sums[..., 0] - sums[..., 1], sums[..., 1]], axis=-1)
    size, kept = stored.shape[-1], doubles(stored.ravel())
    roots = [node(tree, 1)[0] for tree in range(len(trees))]
    if not boosted:
        model = ml.classification.DecisionTreeClassificationModel(learner.uid, roots[0], width, 2)
        return learner._copyValues(DecisionTreeClassificationModel(model))
    members, regression = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(roots)), ml.regression.DecisionTreeRegressionModel
    for i, root in enumerate(roots):
        members[i] = regression(f"{learner.uid}_tree{i}", root, width)
    model = ml.classification.GBTClassificationModel(learner.uid, members, doubles(t[2] for t in trees), width)
    return learner._copyValues(GBTClassificationModel(model))
