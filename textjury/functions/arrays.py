"""Array expressions that replace a shuffle by work inside the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    An expression used inside a lambda is evaluated for every element; a lambda
    variable is not.
    """
    return F.transform(F.array(value), body)[0]


def counted(values: Column, value_name: str, count_name: str) -> Column:
    """Distinct values with their number of occurrences, as ``array<struct>``.

    A message is one row, so counting inside it needs no shuffle on
    (message, value): sort, keep the index where each run starts, take the
    distance to the next start. O(n log n) for a text of n tokens.
    """

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            positions, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return bind(starts, lambda s: lengths(ordered, s, size))

    def lengths(ordered: Column, starts: Column, size: Column) -> Column:
        return F.transform(
            starts,
            lambda start, nth: F.struct(
                F.get(ordered, start).alias(value_name),
                (F.coalesce(F.get(starts, nth + 1), size) - start)
                .cast("bigint")
                .alias(count_name),
            ),
        )

    return bind(F.sort_array(values), runs)
