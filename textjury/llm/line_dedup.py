"""Line dedup across documents with levelled sorted runs of line hashes.

All line keys seen so far lie in runs: tables bucketed and sorted by hash. A batch's keys
are merge-joined with every run, which moves no run between tasks; Spark sorts the files
of a bucket once more for the join. Keys found were seen before, the others become a new
run. Runs of a level are merged into one of the next level as soon as there are enough of
them, by a shuffle and sort of their keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.functions.arrays import bind
from textjury.llm.common import BLANKS, new_folder, stored, unused

LEAST_KEY = 10  # code points
BATCHES = 4
FAN_OUT = 3
HASH = ["h1", "h2"]
LINES = "doc_id long, text_hash long, pos int, h1 long, h2 long"


def hash_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_KEY) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2) of every line whose key is long enough.

    The key is the line without blanks at both ends and with A-Z in lower case; h1 and h2
    are its 128-bit hash. ``text_hash`` tells rows with the same id apart. Null text is
    one empty line.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at, pos, digests = [], [], []
            for i, value in enumerate(batch.column(2).to_pylist()):
                for j, line in enumerate(value.split("\n")):
                    line = line.strip(BLANKS)
                    if len(line) >= least:
                        at.append(i)
                        pos.append(j)
                        digests.append(xxhash.xxh3_128_digest(line.encode().lower()))
            halves = pa.Array.from_buffers(pa.int64(), 2 * len(digests), [None, pa.py_buffer(b"".join(digests))])
            rows_of = pa.array(at, pa.int64())
            even = pa.array(range(0, 2 * len(digests), 2), pa.int64())
            odd = pa.array(range(1, 2 * len(digests), 2), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows_of),
                    batch.column(1).take(rows_of),
                    pa.array(pos, pa.int32()),
                    halves.take(even),
                    halves.take(odd),
                ],
                names=["doc_id", "text_hash", "pos", *HASH],
            )

    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.alias("text")
    ).mapInArrow(batches, LINES)


class LineRuns:
    """The line keys of all batches so far, each with the document that keeps its lines."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT, buckets: int | None = None):
        self.spark = spark
        self.fan_out = fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch of hashed lines; returns (doc_id, text_hash, pos) of those to drop.

        A key of an earlier batch loses all its lines here, but for those of the document
        that holds it already. A new key keeps those of the smallest doc_id in this batch;
        a null doc_id counts as larger than any. Feed batches by ascending doc_id to keep
        the smallest overall.
        """
        place = F.coalesce("doc_id", F.lit(2**63 - 1))
        keys = lines.groupBy(HASH).agg(F.min(place).alias("first"), F.max(place).alias("last"))
        known = F.lit(None).cast("long")
        for i, run in enumerate(self.runs()):
            keys = keys.join(run.withColumnRenamed("owner", f"owner{i}"), HASH, "left")
            known = F.coalesce(known, F.col(f"owner{i}"))
        merged = stored(keys.select(*HASH, "first", "last", known.alias("known")), "line-keys")
        shared = merged.where("known is not null or last > first").select(
            *HASH, F.coalesce("known", "first").alias("owner")
        )
        self._put(merged.where("known is null").select(*HASH, F.col("first").alias("owner")), 0)
        dropped = lines.join(shared, HASH).where(place != F.col("owner"))
        return dropped.select("doc_id", "text_hash", "pos")

    def _put(self, keys: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        held = self.levels[level]
        held.append(self._write(keys))
        if len(held) >= self.fan_out:
            self.levels[level] = []
            self._put(reduce(DataFrame.unionByName, map(self.spark.table, held)), level + 1)
            self._forget(held)

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        keys.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option(
            "path", new_folder(self.spark, "line-run")
        ).saveAsTable(name)
        return name

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        """Take the runs out of the catalog; their files stay with the application's folder."""
        for level in self.levels:
            self._forget(level)
        self.levels = []


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES, fan_out: int = FAN_OUT
) -> DataFrame:
    """(doc_id, text_hash, dropped): the places of each document's lines that a smaller doc_id holds.

    The documents go through the runs in ``batches`` ranges of doc_id. The ranges change
    the amount of work at a time, not the result.
    """
    spark = docs.sparkSession
    shares = [i / batches for i in range(1, batches)]
    ranges = docs.select(F.percentile_approx(F.col(key).cast("long"), shares, 1000)).first()[0] if shares else None
    cuts = sorted(set(ranges or []))
    batch = reduce(lambda n, cut: n + (F.col("doc_id") > cut).cast("int"), cuts, F.lit(0))
    batch = F.coalesce(batch, F.lit(len(cuts)))  # null ids come last
    lines = stored(hash_lines(docs, key, text).withColumn("batch", batch), "line-hashes", "batch")
    runs = LineRuns(spark, fan_out)
    try:
        dropped = [
            stored(runs.add(lines.where(F.col("batch") == i).drop("batch")), f"lines-dropped-{i}")
            for i in range(len(cuts) + 1)
        ]
    finally:
        runs.close()
    return (
        reduce(DataFrame.unionByName, dropped)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("pos").alias("dropped"))
    )


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES, fan_out: int = FAN_OUT
) -> DataFrame:
    """``docs`` with repeated lines gone from the text, and (n_lines, n_dropped) added.

    A line whose key (stripped of blanks, A-Z in lower case) has at least ten code points
    and occurs in two or more documents stays in the smallest doc_id only, there with all
    its repeats. Rows with the same doc_id are one document in this. Null ids come last;
    lines that only they hold stay. Null and empty texts are one empty line and come out
    empty. An empty table gives no rows. Input columns named n_lines or n_dropped are
    replaced by those of this operator; all others stay, whatever their names.
    """
    docs = docs.drop(*({"n_lines", "n_dropped"} - {key, text}))
    doc, hashed, places = unused(docs, "_doc", "_hash", "_dropped")
    repeated = repeated_lines(docs, key, text, batches, fan_out).withColumnsRenamed(
        {"doc_id": doc, "text_hash": hashed, "dropped": places}
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    joined = docs.join(
        repeated,
        F.col(key).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(whole) == F.col(hashed)),
        "left",
    )
    lines = F.split(whole, "\n", -1)
    staying = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
    kept = bind(lines, lambda of: F.array_join(F.transform(staying, lambda i: F.get(of, i)), "\n"))
    return joined.withColumns(
        {
            text: F.when(F.col(places).isNull(), whole).otherwise(kept),
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.coalesce(F.size(places), F.lit(0)).cast("long"),
        }
    ).drop(doc, hashed, places)


DEDUP_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM rows),
keyed AS (
    SELECT r, doc_id, line, pos,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM placed),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k),
judged AS (
    SELECT r, keyed.doc_id, line, pos, coalesce(owner <> keyed.doc_id, false) AS dropped
    FROM keyed LEFT JOIN owners ON keyed.k = owners.k)
SELECT any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count_if(dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY r
"""
