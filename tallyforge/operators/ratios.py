"""Guarded ratios and order-independent means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, scale: int = 1, positive_only: bool = False) -> Column:
    """num / den * scale as double, NULL for a zero or missing denominator.

    With ``positive_only`` a negative denominator gives NULL as well.
    """
    n, d = num.cast("double"), den.cast("double")
    value = n / d
    if scale != 1:
        value = value * scale
    return F.when(d > 0 if positive_only else d != 0, value)


def growth_pct(value: Column, base: Column) -> Column:
    """Change against ``base`` in percent."""
    return ratio(value - base, base, 100)


def exact_mean(value: Column) -> Column:
    """Mean of an exact number: decimal sum over count, so row order has no effect."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def ratio_of_sums(num: str, den: str, scale: int = 1) -> str:
    """SQL text of sum(num) / sum(den), NULL when the denominator sums to zero."""
    text = f"CAST(SUM({num}) AS DOUBLE) / NULLIF(CAST(SUM({den}) AS DOUBLE), 0)"
    return text if scale == 1 else f"{text} * {scale}"
