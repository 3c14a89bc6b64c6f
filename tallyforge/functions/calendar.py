"""Fiscal calendar: date attributes, period keys and period arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CALENDAR_COLUMNS = [
    "time_id",
    "calendar_date",
    "fiscal_year",
    "fiscal_quarter",
    "fiscal_month",
    "fiscal_week",
    "is_month_end",
    "is_quarter_end",
]


def date_key(day: Column) -> Column:
    """yyyymmdd as an int."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def with_fiscal_columns(df: DataFrame, day: str = "calendar_date") -> DataFrame:
    """Add every calendar attribute of column ``day``."""
    d = F.col(day)
    month_end = F.last_day(d) == d
    return df.select(
        "*",
        date_key(d).alias("time_id"),
        F.year(d).alias("fiscal_year"),
        quarter_label(d).alias("fiscal_quarter"),
        F.month(d).alias("fiscal_month"),
        F.weekofyear(d).alias("fiscal_week"),
        month_end.alias("is_month_end"),
        (month_end & (F.month(d) % 3 == 0)).alias("is_quarter_end"),
    )


def calendar_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of the closed range; size is fixed by the two dates."""
    days = (end - start).days + 1
    frame = spark.range(0, days, 1, 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("calendar_date")
    )
    return with_fiscal_columns(frame).select(*CALENDAR_COLUMNS)


def calendar_spanning(dates: DataFrame, column: str) -> DataFrame:
    """Calendar from the first to the last day found in ``column``."""
    day = F.col(column).cast("date")
    frame = dates.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("calendar_date")
    )
    return with_fiscal_columns(frame).select(*CALENDAR_COLUMNS)


def period_key(year: Column, month: Column) -> Column:
    """'YYYY-MM', which sorts in time order."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def quarter_number(label: Column) -> Column:
    """Digit of a label such as 'Q3'."""
    return F.regexp_extract(label, r"(\d)", 1).cast("int")


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0, so that neighbours differ by one across years."""
    return year * 12 + month - 1


def quarter_index(year: Column, label: Column) -> Column:
    return year * 4 + quarter_number(label) - 1


def index_year(index: Column) -> Column:
    return F.floor(index / 12).cast("int")


def index_month(index: Column) -> Column:
    return (index % 12 + 1).cast("int")


def month_quarter(month: Column) -> Column:
    return F.ceil(month / 3).cast("int")
