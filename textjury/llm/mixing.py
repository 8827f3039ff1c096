"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1. Its integral is the
source's share of the budget; inverting the cumulative demand turns the n-th word
taken from a source into a training position, on every pass over the source, and
documents or their reads are range-sorted by it.
Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textjury.llm.common import stored

WEIGHTS = (5, 2, 1)
BUDGET = 1.5  # of all words
MOST_PASSES = 2  # over one source
#: Slope of each source's schedule, by the same rank as the weights: its rate at time t is
#: proportional to 1 + slope * (2t - 1), which integrates to 1 whatever the slope.
SLOPES = (-0.5, 0.0, 0.5)
_RANGE = 2**32


def word_count(text: Column) -> Column:
    """Runs of characters other than blanks; null has none."""
    return F.coalesce(
        F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")), F.lit(0)
    ).cast("long")


def measured(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, source, size, draw) of every row; ``draw`` is the row's fixed random place, 32 hex digits."""
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("draw"),
    )


def source_targets(
    totals: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST_PASSES,
    slopes: Sequence[float] = SLOPES,
) -> DataFrame:
    """Words to take from each source: shares by weight, none above ``most`` times its size.

    ``totals`` is (source, source_size), one row per source; sources are ranked by code
    point, null last, and the weights and slopes repeat along that order. A capped source's
    excess goes to the others by weight. So target = least(cap, weight * level), and the
    level is found in one pass over the sources ordered by cap / weight: the first whose
    cap is not reached when all before it are capped. The windows hold one row per source.
    """
    repeated = lambda values: F.element_at(
        F.array(*[F.lit(float(v)) for v in values]), ((F.col("rank") - 1) % len(values) + 1).cast("int")
    )
    ranked = totals.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumns({"weight": repeated(weights), "slope": repeated(slopes)})
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.col("words") - F.col("capped")) / F.col("open_weight")
    filled = (
        ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumns(
            {
                "words": F.sum("source_size").over(everything) * F.lit(float(budget)),
                "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
                "open_weight": F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            }
        )
        .withColumn("level", F.when(level <= F.col("cap") / F.col("weight"), level))
        .withColumn("level", F.max("level").over(everything))
    )
    reached = F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.col("cap"))
    return filled.select("source", "source_size", "weight", "slope", reached.alias("target"))


def placed(sized: DataFrame, targets: DataFrame, documents: int) -> DataFrame:
    """Each document's first word within its source, in draw order: (..., start).

    A running total per source would put a large source into one task. Draws are cut
    into equal ranges, so the total runs over ranges first and then inside each.
    With as many ranges as the square root of ``documents``, both stay short.
    """
    blocks = max(1, math.isqrt(documents))
    draw = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    rows = sized.withColumn("block", F.floor(draw * blocks / _RANGE).cast("long"))
    offsets = (
        rows.groupBy("source", "block")
        .agg(F.sum("size").alias("block_size"))
        .withColumn(
            "offset",
            F.sum("block_size").over(Window.partitionBy("source").orderBy("block")) - F.col("block_size"),
        )
        .drop("block_size")
    )
    known = targets.join(
        offsets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s")
    inside = Window.partitionBy("source", "block").orderBy("draw", "size")
    rows = rows.withColumn(
        "inside",
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )
    joined = rows.withColumnsRenamed({"source": "s", "block": "b"}).join(
        known, F.col("s").eqNullSafe(F.col("source")) & (F.col("b") == F.col("block"))
    )
    return joined.withColumn("start", F.col("offset") + F.col("inside")).drop(
        "s", "b", "block", "offset", "inside"
    )


def arrival(words: Column, target: Column, slope: Column) -> Column:
    """The time at which the schedule has asked for so many words: the inverse of its integral.

    The integral of 1 + slope * (2t - 1) is t * (1 - slope) + slope * t^2.
    """
    share = F.least(F.greatest(words / target, F.lit(0.0)), F.lit(1.0))
    flat = 1 - slope
    root = (F.sqrt(flat * flat + 4 * slope * share) - flat) / (2 * slope)
    return F.when(F.abs(slope) < 1e-9, share).otherwise(F.least(F.greatest(root, F.lit(0.0)), F.lit(1.0)))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST_PASSES,
    slopes: Sequence[float] = SLOPES,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first_position, reads), one row per input row.

    A source is read in draw order, over and over, until its target is met; the document
    at which that happens counts in part. ``reads`` is an array<struct<position, words>> with
    one entry for each pass in which the document is taken: the training time 0..1 of its
    first word in that pass, and how many words are taken then. ``taken`` is the sum of these
    words, ``first_position`` the position of the first read, null if there is none.

    Rows of a null source form a source of their own, ranked last. Null and empty texts
    have size 0 and nothing is taken of them. Repeated rows are separate documents; rows
    with equal ids come in the order of their size. Null ids are drawn as the empty text.
    An empty table gives no rows. Other columns are ignored.
    """
    sized = stored(measured(docs, key, source, text), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    totals = stored(totals, "mix-sources")
    documents = totals.agg(F.sum("n")).first()[0] or 0
    targets = source_targets(totals.drop("n"), weights, budget, most, slopes)
    rows = placed(sized, targets, documents)
    words = F.floor("target").cast("long")
    # The document's first word of pass p is the (p * source_size + start)-th asked of its source.
    count = F.floor((words - 1 - F.col("start")) / F.col("source_size")) + 1
    none = F.array().cast("array<struct<position:double,words:bigint>>")

    def read(at: Column) -> Column:
        begin = at * F.col("source_size") + F.col("start")
        return F.struct(
            arrival(begin, F.col("target"), F.col("slope")).alias("position"),
            F.least(F.col("size"), words - begin).cast("long").alias("words"),
        )

    reads = F.when(
        (F.col("size") > 0) & (F.col("start") < words), F.transform(F.sequence(F.lit(0), count - 1), read)
    ).otherwise(none)
    return (
        rows.withColumn("reads", reads)
        .withColumns(
            {
                "taken": F.aggregate("reads", F.lit(0).cast("long"), lambda n, r: n + r["words"]),
                "first_position": F.get("reads", 0)["position"],
            }
        )
        .select("doc_id", "source", "size", "source_size", "target", "taken", "first_position", "reads")
    )


def training_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """The mixed documents as a training stream: range-sorted by position, never-taken ones last.

    Each partition holds one stretch of training time, and rows inside it are in order.
    """
    order = [F.col("first_position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    ranged = mixed.repartitionByRange(partitions, *order) if partitions else mixed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def training_stream(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """(doc_id, source, pass, position, words): one row per read, range-sorted by position.

    A document that is taken in several passes comes once for each, at that pass's place;
    never-taken ones are not in the stream.
    """
    reads = mixed.select("doc_id", "source", F.posexplode("reads").alias("pass", "read"))
    reads = reads.select("doc_id", "source", "pass", "read.position", "read.words")
    order = [F.col("position"), F.col("doc_id").asc_nulls_last(), F.col("pass")]
    ranged = reads.repartitionByRange(partitions, *order) if partitions else reads.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


MIX_SQL = """
WITH sized AS (
    SELECT doc_id, CAST(source AS VARCHAR) AS source,
           CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
    FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
    SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
           row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
    FROM totals),
filled AS (
    SELECT *, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
               - coalesce(sum(2.0 * source_size) OVER before, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM ranked
    WINDOW before AS (ORDER BY 2.0 * source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
    SELECT source, source_size,
           coalesce(least(2.0 * source_size, weight * max(CASE WHEN level <= 2.0 * source_size / weight THEN level END) OVER ()),
                    2.0 * source_size) AS target
    FROM filled),
placed AS (
    SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(floor(target) AS BIGINT) AS words,
           sum(size) OVER (PARTITION BY s.source ORDER BY draw, size ROWS UNBOUNDED PRECEDING) - size AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (words // source_size) * size
            + least(greatest(words - (words // source_size) * source_size - start, 0), size) END AS BIGINT) AS taken
FROM placed
"""

#: The rows of ``training_stream``, by the same targets.
STREAM_SQL = (
    MIX_SQL.partition("placed AS (")[0]
    + """sloped AS (
    SELECT *, CAST(target AS DOUBLE) AS asked, CAST(floor(target) AS BIGINT) AS upto,
           CAST(([-0.5, 0.0, 0.5])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS slope
    FROM targets),
placed AS (
    SELECT doc_id, s.source, size, source_size, asked, upto, slope,
           CAST(sum(size) OVER (PARTITION BY s.source ORDER BY draw, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
    FROM sized s JOIN sloped t ON s.source IS NOT DISTINCT FROM t.source),
reads AS (
    SELECT *, unnest(range(CASE WHEN size > 0 AND start < upto THEN (upto - 1 - start) // source_size + 1 ELSE 0 END)) AS pass
    FROM placed),
shares AS (SELECT *, pass * source_size + start AS begin, least((pass * source_size + start) / asked, 1.0) AS share FROM reads)
SELECT doc_id, source, pass,
       CASE WHEN slope = 0 THEN share
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END AS position,
       least(size, upto - begin) AS words
FROM shares
"""
)
