"""Approximate token counts in bounded space, by Spark's own count-min sketch.

A vocabulary of all tokens grows with the corpus; a sketch does not. Its estimates are never below the
count, and above it by more than ``error`` times all tokens for at most ``1 - confidence`` of the tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.functions.arrays import counted

ERROR, CONFIDENCE, SEED = 1e-4, 0.99, 1
#: Tasks that add up partial sketches; each of them gets the sketches of so many map tasks.
MERGE_GROUPS = 64
# Layout of a stored sketch: version (4 bytes), total (8), depth (4), width (4), then 8 bytes per coefficient and cell.
_TOTAL, _DEPTH, _WIDTH, _NUMBERS = 5, 13, 17, 21
_PRIME = 2**31 - 1


def token_number(token: Column) -> Column:
    """The token as a number below 2**32, so that its products with the coefficients stay below 2**63."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def _head(sketch: Column, start: int, size: int) -> Column:
    return _number(F.hex(F.substr(sketch, F.lit(start), F.lit(size))))


def _numbers(sketch: Column) -> Column:
    """Coefficients, then cells, in one pass (a substring for each would copy the sketch each time)."""
    digits = F.hex(F.substr(sketch, F.lit(_NUMBERS)))
    return F.transform(F.regexp_extract_all(digits, F.lit("[0-9A-F]{16}"), F.lit(0)), _number)


def count_sketch(
    df: DataFrame,
    words: str = "words",
    error: float = ERROR,
    confidence: float = CONFIDENCE,
    seed: int = SEED,
    groups: int = MERGE_GROUPS,
) -> DataFrame:
    """One row (total, depth, width, coefficients, cells) that counts the tokens of all rows.

    Each map task sketches its own tokens, so a token's rows never meet in one task and no
    vocabulary is shuffled. The sketches are added up in ``groups`` tasks, then cell by cell:
    at most ``groups`` times depth times width numbers, whatever the input. Null words count
    as none; a table without tokens gives a sketch of zeros.
    """
    numbers = df.select(
        (F.spark_partition_id() % groups).alias("part"), F.explode(F.col(words)).alias("token")
    ).where("token is not null")
    partial = numbers.groupBy("part").agg(
        F.count_min_sketch(token_number(F.col("token")), F.lit(error), F.lit(confidence), F.lit(seed)).alias("sketch")
    )
    empty = df.sparkSession.range(0).agg(  # the layout, where no task has a token
        F.count_min_sketch("id", F.lit(error), F.lit(confidence), F.lit(seed)).alias("sketch")
    )
    every = partial.select("sketch").unionByName(empty)
    read = every.select(
        _head(F.col("sketch"), _TOTAL, 8).alias("total"),
        _head(F.col("sketch"), _DEPTH, 4).cast("int").alias("depth"),
        _head(F.col("sketch"), _WIDTH, 4).alias("width"),
        _numbers(F.col("sketch")).alias("numbers"),
    ).select(
        "total",
        "depth",
        "width",
        F.slice("numbers", F.lit(1), F.col("depth")).alias("coefficients"),
        F.slice("numbers", F.col("depth") + 1, F.size("numbers") - F.col("depth")).alias("cells"),
    )
    return add_sketches(read)


def add_sketches(sketches: DataFrame) -> DataFrame:
    """The sum of sketches, one per row: the sketch of all their tokens together.

    They must have one error, confidence and seed; of others the job fails. So stored sketches of
    earlier batches and that of a new batch make the sketch of everything, and only the new rows are read.
    """
    shape = ["depth", "width", "coefficients"]
    # The total travels as one more cell at place -1, so the cells and it come from one pass.
    cells = sketches.select(*shape, F.posexplode(F.concat(F.array("total"), "cells")).alias("place", "n"))
    summed = cells.groupBy(*shape, "place").agg(F.sum("n").alias("n"))
    gathered = summed.groupBy(*shape).agg(F.sort_array(F.collect_list(F.struct("place", "n")))["n"].alias("all"))
    one = F.count(F.lit(1)) == 1
    different = F.raise_error(F.lit("sketches of different error, confidence or seed cannot be added"))
    only = lambda name: F.when(one, F.first(name)).otherwise(different.cast(gathered.schema[name].dataType))
    return gathered.agg(*[only(name).alias(name) for name in (*shape, "all")]).select(
        F.get("all", F.lit(0)).alias("total"), *shape, F.slice("all", F.lit(2), F.size("all") - 1).alias("cells")
    )


def with_estimates(
    df: DataFrame, sketch: DataFrame, token: str = "token", out: str = "estimate", confidence: float = CONFIDENCE
) -> DataFrame:
    """Add how often each token occurs by the one-row ``sketch``; never below the count, null for a null token.

    The sketch, made with the same ``confidence``, is sent once to each task, as scalar subqueries and
    never as a column: depth * width numbers, 1.1 MB by default.
    """
    held = {name: sketch.select(name).scalar() for name in ("depth", "width", "coefficients", "cells")}
    depth = math.ceil(-math.log(1 - confidence) / math.log(2))
    # A generated column is worked out once per row; of a plain one, the estimate holds a copy for each cell.
    number = F.col("_token_number")
    numbered = df.withColumn("_token_number", F.explode(F.array(token_number(F.col(token)))))

    def cell(row: int) -> Column:
        product = F.get(held["coefficients"], F.lit(row)) * number
        mixed = (product + F.shiftright(product, 32)).bitwiseAND(F.lit(_PRIME).cast("bigint"))
        return F.get(held["cells"], (row * held["width"] + mixed % held["width"]).cast("int"))

    other = F.raise_error(F.lit(f"the sketch was not made with confidence {confidence}")).cast("bigint")
    least = cell(0) if depth == 1 else F.least(*[cell(row) for row in range(depth)])
    estimated = numbered.withColumn(out, F.when(held["depth"] != depth, other).when(F.col(token).isNotNull(), least))
    return estimated.drop("_token_number")


def frequent_words(
    df: DataFrame,
    min_count: int,
    words: str = "words",
    sketch: DataFrame | None = None,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """(token, term_count, doc_count) of every token that occurs at least ``min_count`` times, exactly.

    Most distinct tokens of a corpus are rare, and a vocabulary shuffles them all. Here tokens whose
    estimate is below ``min_count`` stay out of the shuffle: an estimate is never below the count, so none
    of those asked for is lost, and the rest are counted exactly. ``sketch`` counts these rows or more.
    """
    sketch = count_sketch(df, words, confidence=confidence) if sketch is None else sketch
    tokens = df.select(F.inline(counted(F.col(words), "token", "n"))).where("token is not null")
    return (
        with_estimates(tokens, sketch, confidence=confidence)
        .where(F.col("estimate") >= min_count)
        .groupBy("token")
        .agg(F.sum("n").alias("term_count"), F.count(F.lit(1)).alias("doc_count"))
        .where(F.col("term_count") >= min_count)
    )


def sketch_error(
    vocabulary: DataFrame, sketch: DataFrame, error: float = ERROR, confidence: float = CONFIDENCE
) -> DataFrame:
    """(n_words, n_terms, n_below, n_above): estimates below the count, and above it by more than the bound.

    ``vocabulary`` has the exact (token, term_count) of the rows that the sketch counted.
    """
    total = sketch.select("total").scalar()
    judged = with_estimates(vocabulary, sketch, confidence=confidence).select(
        "term_count", (F.col("estimate") - F.col("term_count")).alias("over"), (total * error).alias("bound")
    )
    return judged.agg(
        F.count(F.lit(1)).alias("n_words"),
        F.coalesce(F.sum("term_count"), F.lit(0)).alias("n_terms"),
        F.count(F.when(F.col("over") < 0, 1)).alias("n_below"),
        F.count(F.when(F.col("over") > F.col("bound"), 1)).alias("n_above"),
    )
