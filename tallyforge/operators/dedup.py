"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per key: the newest, with a total order among ties.

    ``newest_first`` columns are compared descending, then every other column
    (or ``tie_break``) descending, so the survivor does not depend on file or
    task order. The ``= 1`` filter lets Spark keep only one row per key in each
    map task before the shuffle, so a hot key arrives as at most one row per
    task. Rows with a NULL key form one group.
    """
    fixed = set(keys) | set(newest_first)
    rest = [c for c in (tie_break if tie_break is not None else df.columns) if c not in fixed]
    order = [F.col(c).desc_nulls_last() for c in [*newest_first, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
