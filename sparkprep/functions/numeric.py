"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; 0 where either is null or the denominator is 0."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def above_flag(c: Column, threshold: float) -> Column:
    """1 where ``c`` is strictly above the threshold, else 0; null counts as not above."""
    return F.coalesce(c > F.lit(threshold), F.lit(False)).cast("int")


def outside(c: Column, low: float, high: float) -> Column:
    """True outside the inclusive range; null is a valid value and never outside."""
    return F.coalesce((c < F.lit(low)) | (c > F.lit(high)), F.lit(False))
