"""Member predictions to one verdict."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed texts shown to the user for a vote of 0 and of 1.
VERDICT_NOT_SPAM = "message不是垃圾短信"
VERDICT_SPAM = "message是垃圾短信"


def positive_votes(members: Sequence[str]) -> Column:
    """Members that predict exactly 1; a missing prediction is no vote."""
    return reduce(add, [F.coalesce((F.col(m) == 1).cast("int"), F.lit(0)) for m in members])


def majority_vote(
    df: DataFrame, members: Sequence[str], votes: str = "votes", vote: str = "vote"
) -> DataFrame:
    """1 only with a strict majority, so an even split gives 0."""
    counted = df.withColumn(votes, positive_votes(members))
    return counted.withColumn(vote, (F.col(votes) > len(members) // 2).cast("int"))


def weighted_vote(
    df: DataFrame, members: Sequence[str], weights: Sequence[float], vote: str = "vote"
) -> DataFrame:
    """1 when the members that predict 1 hold more than half of all weight."""
    if len(members) != len(weights):
        raise ValueError(f"{len(members)} members but {len(weights)} weights")
    share = reduce(
        add,
        [F.when(F.col(m) == 1, F.lit(float(w))).otherwise(0.0) for m, w in zip(members, weights)],
    )
    return df.withColumn(vote, (share > sum(weights) / 2).cast("int"))


def f1_weight() -> Column:
    """F1 from tp, fp and fn as a weight: 0 without a true positive, where the reported F1 may be 1."""
    return F.when(F.col("tp") == 0, 0.0).otherwise(2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")))


def verdict(vote: Column) -> Column:
    return F.when(vote == 1, VERDICT_SPAM).when(vote == 0, VERDICT_NOT_SPAM)
