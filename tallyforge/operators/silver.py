"""Raw feed rows to a typed table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyforge.operators.dedup import dedup_latest
from tallyforge.operators.quality import (
    Expectation,
    expectation_report,
    keep_valid,
    observe_expectations,
)
from tallyforge.sources.feeds import INGESTED_AT, RESCUED, SOURCE_FILE, Feed

RESCUED_LINES = "rescued_lines"


def latest_deliveries(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Newest delivery of every key, still in raw text form.

    A line with the wrong number of cells stays in bronze: it must not replace a whole record.
    """
    if RESCUED in bronze.columns:
        bronze = bronze.where(F.col(RESCUED).isNull())
    names = [c for c, _ in feed.columns]
    ordering = [c for c in (INGESTED_AT, SOURCE_FILE) if c in bronze.columns]
    # Columns that the feed does not declare are left behind here.
    return dedup_latest(bronze.select(*names, *ordering), [feed.key], ordering, names)


def typed_columns(feed: Feed) -> list:
    """Declared types; a malformed cell becomes NULL and is counted as a warning."""
    return [
        F.col(c) if kind == "string" else F.col(c).try_cast(kind).alias(c)
        for c, kind in feed.columns
    ]


def cast_rules(feed: Feed) -> list[Expectation]:
    """Warn rules over the raw text: a value that is there must fit its type."""
    return [
        Expectation(f"castable_{c}", f"{c} IS NULL OR try_cast({c} AS {kind}) IS NOT NULL")
        for c, kind in feed.columns
        if kind != "string"
    ]


def to_silver(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Deduplicate, type and drop; rules run on the typed rows."""
    typed = latest_deliveries(bronze, feed).select(*typed_columns(feed))
    return keep_valid(typed, feed.rules)


def to_silver_observed(
    bronze: DataFrame, feed: Feed
) -> tuple[DataFrame, Observation, Observation]:
    """As ``to_silver``, with cast and rule counts gathered by the writing job."""
    raw, casts = observe_expectations(
        latest_deliveries(bronze, feed), cast_rules(feed), f"{feed.silver_table}_casts"
    )
    typed = raw.select(*typed_columns(feed))
    clean, rules = observe_expectations(typed, feed.rules, f"{feed.silver_table}_rules")
    return clean, casts, rules


def silver_report(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Violation counts of one feed, as a table."""
    typed = latest_deliveries(bronze, feed).select(*typed_columns(feed))
    return expectation_report(typed, feed.rules, feed.silver_table)
