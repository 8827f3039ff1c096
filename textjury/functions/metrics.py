"""Precision, recall and F1 with the value 1 wherever the quotient is 0/0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(1.0)).otherwise(part.cast("double") / whole)


def precision(tp: Column, fp: Column) -> Column:
    return _ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return _ratio(tp, tp + fn)


def f1(p: Column, r: Column) -> Column:
    return _ratio(2 * p * r, p + r)
