"""SimHash near-dedup: 64-bit fingerprints, linked through BK-trees, grouped into components.

Fingerprints are sharded so that any two within the radius share at least one shard: of
r + 1 blocks of bits, r differing bits leave one block equal. Each group of fingerprints
with an equal block gets a BK-tree (children keyed by their Hamming distance to the
parent), and each of its members is searched in it along the edges within the radius.
The trees of all shards hold every fingerprint, so they stay in the tasks of their
shards and are never broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.llm.common import stored, unused

SHINGLE = 3  # words
MAX_BITS = 2
SEED = 42
BITS = 64
#: A shard group above this many fingerprints is divided again, by blocks of its other bits.
DIVIDE_ABOVE = 4096
DIVISIONS = 3
FINGERPRINTS_PER_SHARD = 50_000
PAIRS_AT_A_TIME = 200_000
SHINGLES_AT_A_TIME = 1 << 16


def fingerprint(text: bytes | None, n: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is set if it is set in over half the hashes of the text's word n-grams; 0 without words."""
    words = text.lower().split() if text else []  # both look at ASCII only
    if not words:
        return 0
    width = min(n, len(words))
    count = len(words) - width + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, SHINGLES_AT_A_TIME):
        part = words[at : min(at + SHINGLES_AT_A_TIME, count) + width - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(width)]))
        hashes = np.fromiter([xxhash.xxh64_intdigest(s, seed) for s in shingles], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; ``fp`` holds the 64 bits as a signed long.

    ``text_hash`` tells rows with the same id apart.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            values = [fingerprint(v, n, seed) for v in batch.column(2).to_pylist()]
            bits = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), bits], names=["doc_id", "text_hash", "fp"]
            )

    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).cast("binary").alias("text"),
    ).mapInArrow(batches, "doc_id long, text_hash long, fp long")


class BKForest:
    """One BK-tree per group, as arrays: each fingerprint is a node.

    ``group`` must be sorted, and fingerprints distinct inside a group. A group's first
    member is its root. All trees grow together, a level at a time.
    """

    def __init__(self, group: np.ndarray, bits: np.ndarray):
        n = len(bits)
        self.bits = bits
        first = np.r_[True, group[1:] != group[:-1]] if n else np.zeros(0, bool)
        self.root = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, np.int64)
        keys, nodes = [], []
        waiting = np.flatnonzero(~first)
        parent = self.root[waiting]
        while len(waiting):
            edge = parent * (BITS + 1) + np.bitwise_count(bits[waiting] ^ bits[parent])
            taken, at, inverse = np.unique(edge, return_index=True, return_inverse=True)
            keys.append(taken)
            nodes.append(waiting[at])
            below = np.ones(len(waiting), bool)
            below[at] = False
            parent = waiting[at][inverse][below]
            waiting = waiting[below]
        self.edge = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        child = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        order = np.argsort(self.edge, kind="stable")
        self.edge, self.child = self.edge[order], child[order]

    def near(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (a, b): every pair of members of a group within the radius, from both sides.

        A query at distance d from a node goes on to the children at edges d - radius to
        d + radius. Open (query, node) pairs are kept in bounded blocks, deepest first.
        """
        everything = np.arange(len(self.bits))
        open_pairs = [
            (everything[i : i + PAIRS_AT_A_TIME], self.root[i : i + PAIRS_AT_A_TIME])
            for i in range(0, len(everything), PAIRS_AT_A_TIME)
        ]
        while open_pairs:
            query, node = open_pairs.pop()
            distance = np.bitwise_count(self.bits[query] ^ self.bits[node]).astype(np.int64)
            hit = (distance <= radius) & (query != node)
            yield query[hit], node[hit]
            queries, nodes = [], []
            for off in range(-radius, radius + 1):
                wanted = node * (BITS + 1) + distance + off
                ok = (distance + off >= 0) & (distance + off <= BITS)
                at = np.searchsorted(self.edge, wanted)
                ok &= at < len(self.edge)
                ok[ok] = self.edge[at[ok]] == wanted[ok]
                queries.append(query[ok])
                nodes.append(self.child[at[ok]])
            query, node = np.concatenate(queries), np.concatenate(nodes)
            open_pairs += [
                (query[i : i + PAIRS_AT_A_TIME], node[i : i + PAIRS_AT_A_TIME])
                for i in range(0, len(query), PAIRS_AT_A_TIME)
            ]


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of a[i] and b[i]; a class is labelled by its least index."""
    while True:
        one, other = label[a], label[b]
        apart = one != other
        if not apart.any():
            return label
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        np.minimum.at(label, np.maximum(one, other), np.minimum(one, other))
        while (jumped := label[label]).tobytes() != label.tobytes():
            label = jumped


def _blocks(bits: list[int], parts: int) -> list[int]:
    """Masks that share ``bits`` out into ``parts`` nearly equal blocks."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def shards(
    distinct: DataFrame, radius: int, divide_above: int = DIVIDE_ABOVE, divisions: int = DIVISIONS
) -> DataFrame:
    """(mask, value, fp): each fingerprint under every shard group it belongs to.

    Two fingerprints within the radius that are in one group agree on one of r + 1 blocks
    of the bits that the group leaves open, so a large group is divided without losing a pair.
    """
    masks = {0: _blocks(list(range(BITS)), radius + 1)}
    rows = distinct.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"), "fp")
    done = []
    for division in range(divisions):
        finer = F.create_map(
            *[x for m, subs in masks.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(m | s)) for s in subs]))]
        )
        rows = rows.select("fp", F.explode(finer[F.col("mask")]).alias("mask")).select(
            "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"
        )
        masks = {
            m | s: _blocks([b for b in range(BITS) if not (m | s) >> b & 1], radius + 1)
            for m, subs in masks.items()
            for s in subs
        }
        if division + 1 == divisions:
            break
        large = stored(
            rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > divide_above).drop("n"),
            "large-shards",
        )
        if large.isEmpty():
            break
        done.append(rows.join(large, ["mask", "value"], "left_anti"))
        rows = rows.join(large, ["mask", "value"], "left_semi")
    for part in done:
        rows = rows.unionByName(part)
    return rows


def local_links(groups: DataFrame, radius: int, tasks: int) -> DataFrame:
    """(fp, root): each fingerprint that has a neighbour in a group, with the least one it reaches there."""

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in rows if b.num_rows]
        if not batches:
            return
        mask, value, bits = (
            np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches]) for i in range(3)
        )
        order = np.lexsort((bits, value, mask))
        mask, value, bits = mask[order], value[order], bits[order]
        start = np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]
        group = np.cumsum(start) - 1
        several = np.bincount(group)[group] > 1
        group, bits = group[several], bits[several]
        label = np.arange(len(bits))
        for a, b in BKForest(group, bits.view(np.uint64)).near(radius):
            label = unite(label, a, b)
        linked = np.bincount(label, minlength=len(label))[label] > 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(bits[linked]), pa.array(bits[label[linked]])], names=["fp", "root"]
        )

    return groups.repartition(tasks, "mask", "value").mapInArrow(search, "fp long, root long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the least node that each one reaches.

    Every node hooks to its least lower neighbour; the trees that arise are flattened by
    pointer doubling and the links move to their roots, until none is left. Each round
    leaves at most half of the nodes, and hubs are pre-aggregated before each shuffle.
    """
    oriented = lambda df: df.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    links = stored(oriented(links), "links")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        parent = stored(links.groupBy("a").agg(F.min("b").alias("p")), "parents")
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            doubled = stored(
                parent.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")),
                "parents",
            )
            parent = doubled.drop("moved")
            if doubled.where("moved").isEmpty():
                break
        rounds.append(parent)
        for end in ("a", "b"):
            moved = parent.select(F.col("a").alias(end), F.col("p").alias("to"))
            links = links.join(moved, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        links = stored(oriented(links), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # A node hooked in a later round was a root before, so the rounds apply one after another.
    nodes = rounds[0].select(F.col("a").alias("node"), F.col("p").alias("component"))
    for parent in rounds[1:]:
        step = parent.select(F.col("a").alias("component"), F.col("p").alias("to"))
        nodes = nodes.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        nodes = nodes.unionByName(parent.select(F.col("a").alias("node"), F.col("p").alias("component")))
        nodes = stored(nodes, "components")
    return nodes


def simhash_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE,
    radius: int = MAX_BITS,
    divide_above: int = DIVIDE_ABOVE,
) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, component_fp), one row per input row.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest doc_id reachable, the document's own included, and
    ``component_fp`` a fingerprint that names the component. A text
    of fewer than n words is one shingle; null, empty and blank texts have fingerprint 0
    and are linked like any other. Repeated rows are linked by their equal fingerprints.
    Null ids take part but never name a component, unless all ids of it are null. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    printed = stored(fingerprints(docs, key, text, n), "fingerprints")
    distinct = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    size = distinct.count() * (radius + 1)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FINGERPRINTS_PER_SHARD))
    local = stored(local_links(shards(distinct.select("fp"), radius, divide_above), radius, tasks), "local-links")
    low = local.groupBy("fp").agg(F.min("root").alias("low"))
    across = local.join(low, "fp").select(F.col("root").alias("a"), F.col("low").alias("b"))
    joined = components(across)
    labelled = stored(
        low.join(joined, F.col("low") == F.col("node"), "left").select(
            "fp", F.coalesce("component", "low").alias("label")
        ),
        "labels",
    )
    named = labelled.join(distinct, "fp")
    names = named.groupBy("label").agg(F.min("first").alias("component_id"))
    linked = named.join(names, "label").select("fp", "component_id", F.col("label").alias("component_fp"))
    of_fp = distinct.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("component_id", "first").alias("component_id"),
        F.coalesce("component_fp", "fp").alias("component_fp"),
    )
    # Stored, so that both sides of the last join are plain exchanges: the rows of a
    # fingerprint that many copies share are then split over several tasks.
    of_fp = stored(of_fp, "component-of-fingerprint")
    return printed.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "component_id", "component_fp")


def hex_fingerprint(fp: str) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, nulls last.

    Of rows that share this id the one with the least text hash stays, and of rows that
    are equal in id and text any one. All columns of ``docs`` stay, whatever their names.
    """
    identity = id_name, no_id, hash_name = unused(docs, "_key", "_no_key", "_hash")
    grouped = simhash_components(docs, key, text, **settings)
    order = F.struct(F.col("doc_id").isNull().alias(no_id), F.col("doc_id").alias(id_name), F.col("text_hash").alias(hash_name))
    kept = (
        grouped.groupBy("component_fp")
        .agg(F.min(order).alias("row"))
        .select(F.coalesce(F.col(f"row.{id_name}"), F.lit(0)).alias(id_name), f"row.{no_id}", f"row.{hash_name}")
    )
    own = F.col(key).cast("long")
    return (
        docs.withColumns({id_name: F.coalesce(own, F.lit(0)), no_id: own.isNull(), hash_name: F.xxhash64(text)})
        .join(kept, identity, "left_semi")
        .dropDuplicates(identity)
        .drop(*identity)
    )
