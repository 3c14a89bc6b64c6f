"""Latest period, trailing periods and look-ups across years and scenarios."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.calendar import month_index, quarter_index


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def prior_year_value(
    value: str, keys: Sequence[str], year: str = "fiscal_year"
) -> Column:
    """``value`` of the same keys one year earlier, NULL where there is none.

    A value-range frame of exactly -1 replaces a self-join, so the aggregate is
    computed once. A NULL key never matches, as in a join.
    """
    frame = Window.partitionBy(*keys).orderBy(year).rangeBetween(-1, -1)
    return F.when(_all_present([*keys, year]), F.sum(value).over(frame))


def scenario_value(
    value: str, scenario: str, keys: Sequence[str], scenario_column: str = "scenario_name"
) -> Column:
    """``value`` of one scenario, spread to every row with the same keys."""
    picked = F.when(F.col(scenario_column) == scenario, F.col(value))
    return F.when(_all_present(keys), F.max(picked).over(Window.partitionBy(*keys)))


def _trailing(df: DataFrame, index: Column, count: int) -> DataFrame:
    # The newest period is a scalar subquery: one partial maximum per task, and
    # no window over the whole table.
    newest = df.select(F.max(index)).scalar()
    return df.where(index > newest - count)


def last_quarters(df: DataFrame, count: int = 1) -> DataFrame:
    """Rows of the newest ``count`` fiscal quarters that the table holds."""
    return _trailing(df, quarter_index(F.col("fiscal_year"), F.col("fiscal_quarter")), count)


def last_months(df: DataFrame, count: int = 1) -> DataFrame:
    return _trailing(df, month_index(F.col("fiscal_year"), F.col("fiscal_month")), count)


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry the largest value of ``column``."""
    return df.where(F.col(column) == df.select(F.max(column)).scalar())
