"""Display text for report values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def currency_label(value: Column, prefix: str = "$", suffix: str = "") -> Column:
    """Money with a magnitude letter: $1.5B, $2.0M, $3.4K, $987."""
    v = value.cast("double")

    def scaled(unit: float, letter: str) -> Column:
        return F.format_string(f"{prefix}%.1f{letter}{suffix}", F.bround(v / unit, 1))

    size = F.abs(v)
    return (
        F.when(size >= 1e9, scaled(1e9, "B"))
        .when(size >= 1e6, scaled(1e6, "M"))
        .when(size >= 1e3, scaled(1e3, "K"))
        .otherwise(
            F.concat(F.lit(prefix), F.format_number(F.bround(v, 0), 0), F.lit(suffix))
        )
    )


def millions_label(value: Column, negative: bool = False) -> Column:
    """Waterfall caption in millions; ``negative`` puts the sign before the dollar."""
    size = F.bround(value.cast("double") / 1e6, 1)
    return F.format_string(("-" if negative else "") + "$%.1fM", size)


def percent_label(value: Column) -> Column:
    return F.format_string("%.1f%%", F.bround(value.cast("double"), 1))


def slug(value: Column) -> Column:
    """Lower case with everything but letters and digits removed."""
    return F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), "[^a-z0-9]+", "")
