"""Interactions of quality filters, from sorted posting lists of failing documents.

Each filter has a list of the documents that fail it, in order of their id, for every part of
the corpus and every range of ids. Unions and differences of these lists are merged range by
range with galloping steps; only their sizes leave a range. Sizes of all ranges are added up,
and say for every order of the filters what each removes, finds removed already, and costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.functions.arrays import bind
from textjury.llm.common import UPPER, lookup, stored

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # in 100 words
MOST_CAPITALS = 5  # in 100 code points
SYMBOLS = "[#$%&*|]"
ROWS_PER_RANGE = 1 << 18


def failing(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: few words, few distinct ones, many capitals, symbols."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def bits(w: Column) -> Column:
        capitals = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
        conditions = [
            F.size(w) < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)).cast("long") < LEAST_DISTINCT * F.size(w).cast("long"),
            100 * capitals.cast("long") > MOST_CAPITALS * F.char_length(text).cast("long"),
            text.rlike(SYMBOLS),
        ]
        total = F.lit(0)
        for at, condition in enumerate(conditions):
            total = total + F.when(condition, 1 << at).otherwise(0)
        return total

    return bind(words, bits)


def galloped(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which entries of one ascending list are in another.

    Every entry doubles its stride until it has passed its place, then halves back; all step at once.
    """
    if not len(long):
        return np.zeros(len(short), bool)
    last = len(long) - 1
    low, high, stride = np.zeros(len(short), np.int64), np.zeros(len(short), np.int64), 1
    while (rising := (high <= last) & (long[np.minimum(high, last)] < short)).any():
        low[rising] = high[rising] + 1
        high[rising] += stride
        stride *= 2
    high = np.minimum(high, len(long))
    while (apart := low < high).any():
        middle = (low + high) // 2
        less = apart & (long[np.minimum(middle, last)] < short)
        low = np.where(less, middle + 1, low)
        high = np.where(apart & ~less, middle, high)
    return (low <= last) & (long[np.minimum(low, last)] == short)


def union(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Two ascending lists merged; what the longer one lacks of the shorter one is put in its place."""
    short, long = (one, other) if len(one) <= len(other) else (other, one)
    new = short[~galloped(short, long)]
    return np.insert(long, np.searchsorted(long, new), new) if len(new) else long


def common(one: np.ndarray, other: np.ndarray) -> int:
    """How many entries two ascending lists share."""
    short, long = (one, other) if len(one) <= len(other) else (other, one)
    return int(galloped(short, long).sum())


def set_sizes(postings: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(subset, size, good, toxic) of the union of every subset of the lists, each from a smaller one and one list."""
    unions = {0: np.zeros(0, np.int64)}
    for subset in range(1, 1 << len(postings)):
        top = subset.bit_length() - 1
        unions[subset] = merged = union(unions[subset ^ 1 << top], postings[top])
        yield subset, len(merged), common(good, merged), common(toxic, merged)


def _range_sizes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, subset, n, good, toxic) of the ranges of ids in one partition, sorted by part and id; subset 0 counts all."""
    names = ["part", "subset", "n", "good", "toxic"]
    held, size = [], 0

    def sizes() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        part = table.column("part").combine_chunks()
        bits = table.column("bits").to_numpy()
        starts = np.r_[0, np.flatnonzero(np.asarray(pc.not_equal(part[1:], part[:-1]))) + 1, len(part)].astype(np.int64)
        out = []
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
            # A row's place in its range stands for its id; it tells rows with equal ids apart.
            listed = [np.flatnonzero(bits[lo:hi] >> f & 1) for f in range(len(FILTERS) + 2)]
            name = part[lo].as_py()
            out.append((name, 0, hi - lo, 0, 0))
            out += [(name, *row) for row in set_sizes(listed[: len(FILTERS)], *listed[len(FILTERS) :])]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for batch in rows:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= ROWS_PER_RANGE:
            yield sizes()
            held, size = [], 0
    if held:
        yield sizes()


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, doc_id, bits): filters a document fails (bits 0 to 4), whether it is good (5) and toxic (6)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.md5(text.cast("binary")).alias("text_hash"),
        failing(text).alias("bits"),
    )
    rows = stored(rows, "judged")
    total = rows.count()
    # The smallest id of each text passes E; copies meet after a minimum in every task.
    texts = rows.where("doc_id IS NOT NULL").groupBy("text_hash", "doc_id").agg(F.count("*").alias("weight"))
    firsts = texts.groupBy("text_hash").agg(F.min(F.struct("doc_id", "weight")).alias("least"))
    firsts = firsts.select("text_hash", "least.*", F.lit(True).alias("first"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.max(F.when(F.col("quality") == 1, 32).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 64).otherwise(0))).alias("marks")
    )
    ids = texts.groupBy("doc_id").agg(F.sum("weight").alias("weight")).join(marks, "doc_id")
    known = lookup(rows.where("doc_id IS NOT NULL"), firsts, ["doc_id", "text_hash"], "weight", total, "left")
    known = lookup(known, ids, ["doc_id"], "weight", total, "left")
    copy = F.when(F.col("first").isNull(), 16).otherwise(0)
    known = known.withColumn("bits", F.col("bits") + copy + F.coalesce("marks", F.lit(0)))
    columns = ["part", "doc_id", "bits"]
    return known.select(columns).unionByName(rows.where("doc_id IS NULL").select(columns))


def union_sizes(rows: DataFrame) -> DataFrame:
    """(part, sizes): per part, an array of (subset, n, good, toxic) for the unions of every subset of the failing lists."""
    ranged = rows.repartitionByRange("part", "doc_id", F.rand(0)).sortWithinPartitions("part", "doc_id")
    parts = ranged.mapInArrow(_range_sizes, "part string, subset int, n long, good long, toxic long")
    added = parts.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return added.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("sizes"))


def _steps() -> list[tuple[str, int, int, int, int]]:
    """(filter_order, step, filter, its subset, subset of those before) of every step of every order."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[i] for i in order), step, f, 1 << f, before))
            before |= 1 << f
    return out


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part (``source``; null is the empty string), order of the five filters and step.
    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic; other columns are
    ignored. Null and empty texts have no words. Every row counts, repeated ones too; rows with
    equal id and text are no copies of one another, and a null id is neither a copy nor smaller
    than another. A document is good or toxic if any of its label rows says so; a null id has no
    labels. An empty table has no rows.
    """
    per_part = union_sizes(judged(docs, labels))
    n = lambda subset, what="n": F.get("sizes", subset)[what]
    names = ("filter_order", "step", "f", "own", "before")
    steps = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row)]) for row in _steps()])
    orders = lambda size: factorial(size) * factorial(len(FILTERS) - 1 - size)
    # Union sizes; that of no list is 0, while subset 0 of the array counts all documents.
    of = lambda subset, what="n": F.when(subset > 0, n(subset, what)).otherwise(F.lit(0))
    shapley = []
    for f in range(len(FILTERS)):
        gains = [
            (n(F.lit(s | 1 << f)) - (n(F.lit(s)) if s else 0)) * orders(s.bit_count())
            for s in range(1 << len(FILTERS))
            if not s >> f & 1
        ]
        shapley.append(sum(gains[1:], gains[0]))
    every = (1 << len(FILTERS)) - 1
    rows = per_part.select("part", "sizes", F.array(*shapley).alias("by_filter")).select("part", "sizes", "by_filter", F.inline(steps))
    rows = rows.withColumn("after", F.col("before") + F.col("own"))
    gained = lambda what: of(F.col("after"), what) - of(F.col("before"), what)
    return rows.select(
        "part", "filter_order", "step",
        (n(F.lit(0)) - of(F.col("after"))).alias("kept"),
        gained("n").alias("removed"),
        (of(F.col("own")) - gained("n")).alias("redundant"),
        (n(F.lit(every)) - of(F.lit(every) - F.col("own"))).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        F.get("by_filter", F.col("f")).alias("shapley"),
    )


#: The same counts in DuckDB's SQL, from each document's own failures.
AUDIT_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM docs),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
fails AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, map {
        'A': len(w) < 50,
        'B': 100 * len(list_distinct(w)) < 65 * len(w),
        'C': 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
        'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(doc_id > first, false)} AS f
    FROM words LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
    JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
kinds AS (
    SELECT part, f['A'] AS a, f['B'] AS b, f['C'] AS c, f['D'] AS d, f['E'] AS e, any_value(f) AS f,
           count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM fails GROUP BY ALL),
seen AS (
    SELECT part, filter_order, step, n, good, toxic, f[substr(filter_order, step, 1)] AS own,
           list_contains(list_transform(string_split(substr(filter_order, 1, step - 1), ''), lambda x: coalesce(f[x], false)), true) AS before,
           list_sum(list_transform(map_values(f), lambda x: x::INT)) AS failed
    FROM kinds CROSS JOIN steps),
counted AS (
    SELECT part, filter_order, step::INT AS step,
           sum(n) FILTER (NOT own AND NOT before) AS kept, sum(n) FILTER (own AND NOT before) AS removed,
           sum(n) FILTER (own AND before) AS redundant, sum(n) FILTER (own AND failed = 1) AS unique_fails,
           sum(good) FILTER (own AND NOT before) AS good_lost, sum(toxic) FILTER (own AND NOT before) AS toxic_lost
    FROM seen GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)), 0)::BIGINT AS shapley
FROM counted
"""
