"""Joins of large tables whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy, and joined by broadcast, if it has over 1/4,096 of the rows; so at most 4,095 are.
HEAVY_KEYS = 4_096


def lookup(rows: DataFrame, table: DataFrame, on: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and in ``weight`` how many rows have it.

    Keys above total / HEAVY_KEYS go by broadcast, at most HEAVY_KEYS of them; the rest is shuffled.
    """
    limit = max(32, -(-total // HEAVY_KEYS))
    heavy = F.broadcast(table.where(F.col(weight) > limit).drop(weight))
    light = table.where(F.col(weight) <= limit).drop(weight)
    by_broadcast = rows.join(heavy, on, "inner")
    others = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return by_broadcast.unionByName(others.join(light, on, how), allowMissingColumns=True)
