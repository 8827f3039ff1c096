"""Words of text without blanks, from the text alone.

A character n-gram is a word if its parts occur together far more often than by chance
(cohesion: the least pointwise mutual information over all ways to cut it in two) and if
many different characters come before and after it (branching entropy).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textjury.functions.text import char_windows
from textjury.operators.joins import lookup
from textjury.plans.storage import stored

HAN = r"\p{IsHan}"
MAX_LENGTH = 4
MIN_COUNT = 5
MIN_COHESION = 2.0
MIN_ENTROPY = 1.0
#: Characters that stand for the start and the end of a run, which count as neighbours.
OPEN, CLOSE = "\x02", "\x03"


def gram_counts(df: DataFrame, max_length: int, text: str = "text", script: str = HAN) -> DataFrame:
    """(gram, size, n) of the n-grams of up to ``max_length`` characters in runs of ``script``, with the runs' edges.

    What is counted first is one window per character, of up to ``max_length`` characters to the
    run's end; the n-grams that begin there are its beginnings, so they follow from the distinct
    windows. Both are counted in every task before the shuffle, so a frequent one leaves each task as one row.
    """
    runs = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"[{script}]+"), F.lit(0))
    edged = F.transform(runs, lambda run: F.concat(F.lit(OPEN), run, F.lit(CLOSE)))
    windows = F.flatten(F.transform(edged, lambda run: char_windows(run, max_length)))
    distinct = df.select(F.explode(windows).alias("window")).groupBy("window").agg(F.count(F.lit(1)).alias("n"))
    beginnings = F.transform(
        F.sequence(F.lit(1), F.char_length("window")), lambda size: F.substring(F.col("window"), F.lit(1), size)
    )
    counted = distinct.select(F.explode(beginnings).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    return counted.select("gram", F.char_length("gram").alias("size"), "n")


def _entropy(neighbours: DataFrame, word: Column, name: str) -> DataFrame:
    """(token, name): entropy of what comes beside each word, from n-grams one character longer."""
    n = F.col("n").cast("double")
    return neighbours.groupBy(word.alias("token")).agg(
        (F.log(F.sum(n)) - F.sum(n * F.log(n)) / F.sum(n)).alias(name)
    )


def discover_words(
    df: DataFrame,
    text: str = "text",
    script: str = HAN,
    max_length: int = MAX_LENGTH,
    min_count: int = MIN_COUNT,
    min_cohesion: float = MIN_COHESION,
    min_entropy: float = MIN_ENTROPY,
) -> DataFrame:
    """(token, term_count, cohesion, left_entropy, right_entropy) of the n-grams of 2 to ``max_length`` characters that are words.

    The result can be the word list of :func:`textjury.operators.segmenting.segment`. Nothing
    comes to the driver but the number of n-grams per size. Frequent parts, which very many
    n-grams share, are looked up by broadcast, at most 4,096 of them.
    """
    # Part counts must be whole: a part occurs at least as often as the word it is in.
    grams = stored(gram_counts(df, max_length + 1, text, script), "grams")
    inner = grams.where(~F.col("gram").rlike(f"[{OPEN}{CLOSE}]") & (F.col("size") <= max_length))
    totals = {r["size"]: r["total"] for r in inner.groupBy("size").agg(F.sum("n").alias("total")).collect()}
    candidates = inner.where((F.col("size") > 1) & (F.col("n") >= min_count))
    cuts = F.sequence(F.lit(1), F.col("size") - 1)
    halves = candidates.select("gram", F.explode(cuts).alias("at"), "size").select(
        "gram",
        F.explode(F.array(F.expr("substring(gram, 1, at)"), F.expr("substring(gram, at + 1, size - at)"))).alias("part"),
        "at",
    )
    weights = halves.groupBy("part").agg(F.count(F.lit(1)).alias("weight"))
    parts = inner.select(F.col("gram").alias("part"), F.col("n").alias("n_part"), F.col("size").alias("part_size")).join(weights, "part")
    total = halves.count()
    share = F.col("n_part") / reduce(
        lambda other, size: F.when(F.col("part_size") == size, F.lit(float(totals[size]))).otherwise(other), totals, F.lit(None).cast("double")
    )
    by_chance = lookup(halves, parts, ["part"], "weight", total).groupBy("gram", "at").agg(F.sum(F.log(share)).alias("chance"))
    likeliest = by_chance.groupBy(F.col("gram").alias("token")).agg(F.max("chance").alias("chance"))
    own = reduce(
        lambda other, size: F.when(F.col("size") == size, F.log(F.col("n") / F.lit(float(totals[size])))).otherwise(other), totals, F.lit(None).cast("double")
    )
    scored = candidates.select(F.col("gram").alias("token"), F.col("n").alias("term_count"), own.alias("own")).join(likeliest, "token")
    scored = scored.select("token", "term_count", (F.col("own") - F.col("chance")).alias("cohesion")).where(F.col("cohesion") >= min_cohesion)
    longer = grams.where(F.col("size") > 2)
    left = _entropy(longer.where(~F.col("gram").endswith(CLOSE)), F.expr("substring(gram, 2, size - 1)"), "left_entropy")
    right = _entropy(longer.where(~F.col("gram").startswith(OPEN)), F.expr("substring(gram, 1, size - 1)"), "right_entropy")
    beside = scored.join(left, "token").join(right, "token")
    return beside.where(F.least("left_entropy", "right_entropy") >= min_entropy)
