"""Prefix trie of conversations, in balanced parentheses per shard.

A conversation is a sequence of turns; every distinct beginning is a node. A node is named by
the exclusive or of 128 bits per (position, turn), so it follows from running totals and no
task needs a whole conversation. Chains of nodes with one child are folded into their lowest
node; what remains (branches, ends and the root) is sorted depth first and cut into shards.
A shard writes its nodes as parentheses: findclose, led by the least excess of blocks, delimits
a subtree, the rank of leaf pairs counts its leaves and cumulative weights give its savings.
Nodes open across shards (the spine) leave one part per shard; the parts are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textjury.llm.common import lookup, row_crc, stored

FAMILY = 100  # conversations that begin with turns of the same one
MOST_SHARED = 6  # a conversation shares fewer turns than this
BLOCK = 64  # parentheses whose least excess is kept
SLICE_BYTES = 1 << 16
NODES_PER_SHARD = 100_000


def running(
    rows: DataFrame, key: str, block: str, order: list[Column], totals: dict[str, tuple[Callable, str]]
) -> DataFrame:
    """``rows`` with running totals within ``key`` up to and including each row, name -> (aggregate, column).

    Within a key, the blocks must follow ``order``. Totals run over blocks first and then
    inside each, so a key with a large share of the rows needs no task that sees all of them.
    """
    per_block = rows.groupBy(key, block).agg(*[add(column).alias(name) for name, (add, column) in totals.items()])
    before = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    start = {n: F.coalesce(add(n).over(before), F.lit(0).cast("long")) for n, (add, _) in totals.items()}
    offsets = per_block.select(
        F.col(key).alias("_key"), F.col(block).alias("_block"), *[c.alias(f"_{n}") for n, c in start.items()]
    )
    inside = Window.partitionBy(key, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({n: add(c).over(inside) for n, (add, c) in totals.items()})
    joined = local.join(offsets, (F.col(key) == F.col("_key")) & (F.col(block) == F.col("_block")))
    plus = lambda n, add: F.col(n).bitwiseXOR(F.col(f"_{n}")) if add is F.bit_xor else F.col(n) + F.col(f"_{n}")
    return joined.withColumns({n: plus(n, add) for n, (add, _) in totals.items()}).drop(
        "_key", "_block", *[f"_{n}" for n in totals]
    )


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, block, at, turn_hash, points): ``at`` is the turn's place in its conversation, from 1.

    By ``turn``, null first; equal turns by the MD5 of their role's length, role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        said.alias("turn_hash"),
        F.char_length(text).cast("long").alias("points"),
        F.rand(0).alias("among_equals"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_hash"), F.col("among_equals")]
    dealt = stored(rows.repartitionByRange(*order).withColumn("block", F.spark_partition_id().cast("long")), "turns")
    one = dealt.withColumn("one", F.lit(1).cast("long"))
    numbered = running(one, "conv_id", "block", order[1:], {"at": (F.sum, "one")})
    return stored(numbered.drop("one", "among_equals", "turn"), "ordered-turns")


def rebuilt(turns: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """The turns of rebuilt conversations, and (conv_id, length) of all of them.

    Conversation c shares the first h turns of c - c % family (h = crc32 of c in decimal, modulo
    ``most_shared``; fewer if that one has fewer), and goes on with its own after its first h.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("at") < most_shared))
    heads = first.groupBy(F.col("conv_id").alias("family")).agg(
        F.sort_array(F.collect_list(F.struct("at", "turn_hash", "points"))).alias("first")
    )
    none = F.array().cast("array<struct<at:bigint,turn_hash:string,points:bigint>>")
    plan = (
        own.withColumns({"shared": (row_crc("conv_id") % most_shared).cast("int"), "family": F.col("conv_id") - F.col("conv_id") % family})
        .join(heads, "family", "left")
        .withColumn("head", F.filter(F.coalesce("first", none), lambda t: t["at"] <= F.col("shared")))
        .withColumn("kept", F.size("head").cast("long"))
        .select(
            "conv_id", "shared", "head", "kept", "n_own",
            (F.col("kept") + F.greatest(F.col("n_own") - F.col("shared"), F.lit(0))).alias("length"),
        )
    )
    plan = stored(plan, "conversations")
    shared = plan.select("conv_id", "length", F.lit(-1).cast("long").alias("block"), F.inline("head")).withColumnRenamed("at", "depth")
    moved = turns.withColumn("shared", (row_crc("conv_id") % most_shared).cast("int")).where("at > shared").drop("shared")
    rest = lookup(moved, plan.select("conv_id", "shared", "kept", "length", "n_own"), ["conv_id"], "n_own", plan.agg(F.sum("n_own")).first()[0] or 0)
    rest = rest.withColumn("depth", F.col("at") - F.col("shared") + F.col("kept")).drop("at", "shared", "kept")
    return shared.unionByName(rest), plan.select("conv_id", "length")


def named(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, length, a, b, up_a, up_b, points, ahead): the node of each turn, and its parent.

    ``ahead`` counts the code points of the turns before it.
    """
    marked = rows.withColumns({"x": F.xxhash64("depth", "turn_hash"), "y": F.xxhash64("turn_hash", "depth")})
    totals = {"a": (F.bit_xor, "x"), "b": (F.bit_xor, "y"), "ahead": (F.sum, "points")}
    known = running(marked, "conv_id", "block", [F.col("depth")], totals)
    return known.select(
        "conv_id", "depth", "length", "a", "b",
        F.col("a").bitwiseXOR(F.col("x")).alias("up_a"),
        F.col("b").bitwiseXOR(F.col("y")).alias("up_b"),
        "points", (F.col("ahead") - F.col("points")).alias("ahead"),
    )


class Parentheses:
    """A forest as balanced parentheses, from the depths of its nodes in depth-first order.

    ``leaf`` marks nodes without a child anywhere; of the others at the end, the closes are in a later shard.
    """

    def __init__(self, depth: np.ndarray, leaf: np.ndarray, weight: np.ndarray):
        n = len(depth)
        closes = np.zeros(n, np.int64)
        closes[1:] = depth[:-1] - depth[1:] + 1
        self.open_at = np.arange(n) + np.cumsum(closes)
        size = int(self.open_at[-1]) + 1 + int(leaf[-1]) if n else 0
        step = np.full(size, -1, np.int64)
        step[self.open_at] = 1
        self.excess = np.cumsum(step)
        self.size = size
        pairs = np.zeros(size + 1, np.int64)
        pairs[1:-1] = (step[:-1] == 1) & (step[1:] == -1)
        self.pairs = np.r_[0, np.cumsum(pairs)]  # leaf pairs that open before a place
        weights = np.zeros(size, np.int64)
        weights[self.open_at] = weight
        self.weights = np.r_[0, np.cumsum(weights)]
        padded = np.full(-(-max(size, 1) // BLOCK) * BLOCK, np.iinfo(np.int64).max)
        padded[:size] = self.excess
        self.blocks = padded.reshape(-1, BLOCK)
        self.levels = [self.blocks.min(axis=1)]  # least excess of blocks, of pairs of blocks, and so on
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            low = np.r_[low, np.iinfo(np.int64).max] if len(low) % 2 else low
            self.levels.append(np.minimum(low[::2], low[1::2]))

    def _within(self, block: np.ndarray, start: np.ndarray, below: np.ndarray) -> np.ndarray:
        """First place in a block, from ``start`` on, with an excess of at most ``below``; -1 if none."""
        found = np.full(len(block), -1, np.int64)
        for at in range(0, len(block), 1 << 14):
            part = slice(at, at + (1 << 14))
            hit = (self.blocks[block[part]] <= below[part, None]) & (np.arange(BLOCK) >= start[part, None])
            found[part] = np.where(hit.any(axis=1), block[part] * BLOCK + hit.argmax(axis=1), -1)
        return found

    def _next_block(self, block: np.ndarray, below: np.ndarray) -> np.ndarray:
        """First later block whose least excess is at most ``below``; -1 if none. Up the tree of minima, then down."""
        found, index = np.full(len(block), -1, np.int64), block.copy()
        rising = np.arange(len(block))
        for level, low in enumerate(self.levels):
            right = index[rising] + 1
            fits = (index[rising] % 2 == 0) & (right < len(low))
            fits[fits] = low[right[fits]] <= below[rising[fits]]
            hit = rising[fits]
            at = right[fits]
            for lower in range(level - 1, -1, -1):
                at = 2 * at
                at += self.levels[lower][at] > below[hit]
            found[hit] = at
            rising = rising[~fits]
            index[rising] //= 2
        return found

    def findclose(self) -> np.ndarray:
        """Place of each node's closing parenthesis; the number of places where a later shard has it."""
        below = self.excess[self.open_at] - 1
        block, start = self.open_at // BLOCK, self.open_at % BLOCK + 1
        close = self._within(block, start, below)
        far = np.flatnonzero(close < 0)
        later = self._next_block(block[far], below[far])
        far, later = far[later >= 0], later[later >= 0]
        close[far] = self._within(later, np.zeros(len(far), np.int64), below[far])
        return np.where(close < 0, self.size, close)

    def subtrees(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per node: leaves and weight of its subtree, as far as it lies here, and whether it goes on."""
        close = self.findclose()
        leaves = self.pairs[close + 1] - self.pairs[self.open_at + 1]
        return leaves, self.weights[close] - self.weights[self.open_at], close == self.size


def _shard(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree sums of one shard's nodes, and of those above its first one that began in earlier shards."""
    batches = [b for b in rows if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    a, b, depth, weight, leaf = (table.column(c).to_numpy() for c in ("a", "b", "level", "weight", "leaf"))
    above = np.array(table.column("path")[0].as_py()[:-2], np.int64).reshape(-1, 2)
    a, b = np.r_[above[:, 0], a], np.r_[above[:, 1], b]
    depth = np.r_[np.arange(1, len(above) + 1), depth].astype(np.int64)
    weight = np.r_[np.zeros(len(above), np.int64), weight]
    leaf = np.r_[np.zeros(len(above), bool), leaf.astype(bool)]
    leaves, saved, goes_on = Parentheses(depth, leaf, weight).subtrees()
    spine = goes_on | (np.arange(len(a)) < len(above))
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[part]) for x in (a, b, leaves, saved, spine)], names=["a", "b", "n_leaves", "below", "spine"]
        )


def _ends(ends: DataFrame, shards: int) -> DataFrame:
    """(a, b, ends_sha256): SHA-256 of the ascending ids of the conversations that end at a node.

    Ids are range-sorted and joined into slices where they lie; a node's slices are hashed one
    after the other, so a node where a third of all conversations end needs no more memory.
    """

    sliced = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    digests = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])

    def batch_of(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)

    def slices(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0
        for batch in rows:
            out = []
            for x, y, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (x, y) != node or size >= SLICE_BYTES:
                    if ids:
                        out.append((*node, first, ",".join(ids)))
                    node, first, ids, size = (x, y), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield batch_of(out, sliced)
        if ids:
            yield batch_of([(*node, first, ",".join(ids))], sliced)

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in rows:
            out = []
            for x, y, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (x, y) != node:
                    if digest is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (x, y), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield batch_of(out, digests)
        if digest is not None:
            yield batch_of([(*node, digest.hexdigest())], digests)

    dealt = ends.select("a", "b", "conv_id").repartitionByRange(shards, "a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    cut = stored(dealt.mapInArrow(slices, "a long, b long, first long, ids string"), "end-slices")
    met = cut.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return met.mapInArrow(hashed, "a long, b long, ends_sha256 string")


#: The same nodes in DuckDB's SQL, from whole prefixes.
TRIE_SQL = """
WITH RECURSIVE turns AS (
    SELECT conv_id, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS said,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nth
    FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT conv_id, list(said ORDER BY nth) AS own FROM turns GROUP BY conv_id),
shares AS (
    SELECT conv_id, own, conv_id - conv_id % 100 AS family, xor(list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, byte: list_reduce(range(8)::BIGINT[], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, byte)),
        4294967295::BIGINT), 4294967295) % 6 AS h
    FROM whole),
rebuilt AS (
    SELECT s.conv_id, list_concat(coalesce(list_slice(f.own, 1, s.h), []), list_slice(s.own, s.h + 1, len(s.own))) AS said
    FROM shares s LEFT JOIN whole f ON f.conv_id = s.family),
visits AS (SELECT conv_id, len(said) AS n, unnest(range(len(said) + 1)) AS depth, said FROM rebuilt),
nodes AS (
    SELECT depth, list_slice(said, 1, depth) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
    FROM visits GROUP BY depth, prefix),
children AS (SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix),
beneath AS (
    SELECT list_slice(prefix, 1, top) AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
           sum(CASE WHEN depth > 0 THEN (n_convs - 1) * length(prefix[-1].text) ELSE 0 END) AS saved
    FROM (SELECT *, unnest(range(depth + 1)) AS top FROM counted) GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       n.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM counted n JOIN beneath b ON b.prefix = n.prefix
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
"""


def prefix_trie(conversations: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED, nodes_per_shard: int = NODES_PER_SHARD) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node.

    ``conversations`` has conv_id, turn, role and text; other columns are ignored. Null roles
    and texts are empty, null turns come first, equal turns follow their MD5 (see
    ``ordered_turns``), repeated rows are repeated turns. Rows without a conv_id belong to no
    conversation. A table without conversations has no nodes; the root's parent is null.

    Proven bounds: a node's path holds the branches and ends above it, and each of those has a
    conversation of its own that is at least as long, so of N turns a path has at most sqrt(2 N).
    """
    spark = conversations.sparkSession
    turns = ordered_turns(conversations)
    rows, lengths = rebuilt(turns, family, most_shared)
    paths = stored(named(rows), "trie-paths")
    nodes = paths.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("depth").alias("depth"),
        F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"), F.max("points").alias("points"), F.max("ahead").alias("ahead"),
        F.count_if(F.col("depth") == F.col("length")).alias("n_ends"),
    )
    zero = F.lit(0).cast("long")
    nowhere = F.lit(None).cast("long")
    root = lengths.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("length") == 0).alias("n_ends")
    ).where("n_convs > 0")
    root = root.select(
        zero.alias("a"), zero.alias("b"), "conv_id", "n_convs", zero.alias("depth"), nowhere.alias("up_a"), nowhere.alias("up_b"),
        zero.alias("points"), zero.alias("ahead"), "n_ends",
    )
    everything = stored(nodes.unionByName(root), "trie-nodes")
    children = everything.where("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    everything = stored(everything.join(children, ["a", "b"], "left").fillna(0, ["n_children"]), "trie-counted")
    visits, total = everything.where("depth > 0").agg(F.sum("n_convs"), F.count("*")).first()
    visits, total = visits or 0, total or 0

    kept = everything.where("depth > 0 AND (n_children <> 1 OR n_ends > 0)")
    stops = kept.select("a", "b", F.col("conv_id").alias("owner"), "n_convs", "points", "ahead", "n_children", F.col("n_convs").alias("weight"))
    met = lookup(paths.select("conv_id", "depth", "a", "b"), stops, ["a", "b"], "weight", visits)
    walked = met.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "a", "b", "owner", "n_convs", "points", "ahead", "n_children"))).alias("walk")
    )
    owned = walked.where(F.exists("walk", lambda s: s["owner"] == F.col("conv_id")))
    numbered = F.transform("walk", lambda s, i: F.struct(s.alias("stop"), i.alias("at")))
    each = owned.select("conv_id", "walk", F.explode(F.filter(numbered, lambda s: s["stop"]["owner"] == F.col("conv_id"))).alias("s"))
    end = lambda s: s["ahead"] + s["points"]
    upper = F.when(F.col("s.at") > 0, end(F.get("walk", F.col("s.at") - 1))).otherwise(0)
    branches = each.select(
        "conv_id", F.col("s.stop.depth").alias("depth"), F.col("s.stop.a").alias("a"), F.col("s.stop.b").alias("b"),
        (F.col("s.at") + 1).cast("long").alias("level"),
        F.flatten(F.transform(F.slice("walk", F.lit(1), F.col("s.at") + 1), lambda t: F.array(t["a"], t["b"]))).alias("path"),
        ((F.col("s.stop.n_convs") - 1) * (end(F.col("s.stop")) - upper)).alias("weight"),
        F.col("s.stop.ahead").alias("ahead"), (F.col("s.stop.ahead") - upper).alias("folded"),
        F.col("s.stop.n_convs").alias("n_convs"), (F.col("s.stop.n_children") == 0).alias("leaf"),
    )
    branches = stored(branches, "trie-branches")
    shards = max(spark.sparkContext.defaultParallelism, -(-branches.count() // nodes_per_shard))
    sorted_nodes = branches.select("path", "a", "b", "level", "weight", "leaf").repartitionByRange(shards, "path").sortWithinPartitions("path")
    parts = stored(sorted_nodes.mapInArrow(_shard, "a long, b long, n_leaves long, below long, spine boolean"), "trie-shards")
    spine = parts.where("spine").groupBy("a", "b").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("below").alias("below"))
    sums = parts.where("NOT spine").drop("spine").unionByName(spine)

    # Of a folded chain only the lowest node is in the shards: what the nodes above it save is added here.
    lowest = branches.join(sums, ["a", "b"]).select(
        "conv_id", "a", "b", "depth", "ahead", "n_leaves", (F.col("below") - (F.col("n_convs") - 1) * F.col("folded")).alias("saved")
    )
    lowest = stored(lowest, "trie-sums")
    runs = lowest.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "ahead", "n_leaves", "saved"))).alias("runs"))
    owners = everything.where("depth > 0").groupBy("conv_id").agg(F.count("*").alias("weight"))
    runs = runs.join(owners, "conv_id")
    below_root = everything.where("depth > 0")
    placed = lookup(below_root, runs, ["conv_id"], "weight", total).withColumn(
        "low", F.get(F.filter("runs", lambda r: r["depth"] >= F.col("depth")), F.lit(0))
    )
    done = placed.withColumns(
        {
            "n_leaves": F.col("low.n_leaves"),
            "saved_tokens": F.col("low.saved") + (F.col("n_convs") - 1) * (F.col("low.ahead") - F.col("ahead")),
        }
    ).drop("runs", "low")
    done = stored(done, "trie-placed")
    saved, leaves = done.agg(F.sum((F.col("n_convs") - 1) * F.col("points")), F.count_if(F.col("n_children") == 0)).first()
    top = everything.where("depth = 0").withColumns(
        {"n_leaves": F.lit(max(leaves, 1)).cast("long"), "saved_tokens": F.lit(saved or 0).cast("long")}
    )

    parents = everything.where("n_children > 0").select(
        F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight")
    )
    with_parent = lookup(done, parents, ["up_a", "up_b"], "weight", total)
    complete = with_parent.unionByName(top.withColumn("parent_conv_id", nowhere))
    at_end = paths.where("depth = length").select("a", "b", "conv_id").unionByName(
        lengths.where("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id")
    )
    complete = complete.join(_ends(at_end, shards), ["a", "b"], "left")
    return complete.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
