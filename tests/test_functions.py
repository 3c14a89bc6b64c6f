from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import calendar as cal
from tallyforge.functions import measures as ms
from tallyforge.functions import text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_calendar_rows(spark):
    rows = {r.time_id: r for r in cal.calendar_dim(spark, date(2023, 1, 1), date(2026, 12, 31)).collect()}
    assert len(rows) == 1461
    leap, year_end, new_year = rows[20240229], rows[20251231], rows[20230101]
    assert leap.is_month_end and not leap.is_quarter_end
    assert year_end.is_quarter_end and year_end.fiscal_quarter == "Q4" and year_end.fiscal_week == 1
    assert new_year.fiscal_week == 52 and new_year.calendar_date == date(2023, 1, 1)


def test_calendar_spanning(make):
    df = make([(date(2024, 12, 30),), (date(2025, 1, 2),)], "d date")
    assert [r.time_id for r in cal.calendar_spanning(df, "d").orderBy("time_id").collect()] == [
        20241230, 20241231, 20250101, 20250102,
    ]


@pytest.mark.parametrize("ahead, period", [(1, "2026-01"), (12, "2026-12"), (13, "2027-01"), (18, "2027-06")])
def test_months_after_december(spark, ahead, period):
    index = cal.month_index(F.lit(2025), F.lit(12)) + ahead
    key = cal.period_key(cal.index_year(index), cal.index_month(index))
    assert one(spark, key) == period


def test_quarter_helpers(spark):
    assert one(spark, cal.quarter_number(F.lit("Q3"))) == 3
    assert one(spark, cal.quarter_index(F.lit(2025), F.lit("Q1")) - cal.quarter_index(F.lit(2024), F.lit("Q4"))) == 1
    assert [one(spark, cal.month_quarter(F.lit(m))) for m in (1, 3, 4, 12)] == [1, 1, 2, 4]


@pytest.mark.parametrize(
    "value, label",
    [
        (1.5e9, "$1.5B"),
        (-2.04e6, "$-2.0M"),
        (1234.0, "$1.2K"),
        (1250.0, "$1.2K"),
        (987.4, "$987"),
        (0.0, "$0"),
        (999_999_999.0, "$1000.0M"),
    ],
)
def test_currency_label(spark, value, label):
    assert one(spark, text.currency_label(F.lit(value))) == label


def test_other_labels(spark):
    assert one(spark, text.percent_label(F.lit(12.34))) == "12.3%"
    assert one(spark, text.millions_label(F.lit(12_340_000), True)) == "-$12.3M"
    assert one(spark, text.slug(F.lit("FP&A  Space-1"))) == "fpaspace1"
    assert one(spark, text.currency_label(F.lit(5e6), "EUR ", " net")) == "EUR 5.0M net"


def test_measures(spark):
    assert one(spark, ms.net_amount(F.lit(3), F.lit("19.99"), F.lit("0.1"))) == Decimal("53.97")
    assert one(spark, ms.monthly_interest(F.lit("350000000"), F.lit("0.055"))) == Decimal("1604166.67")
    assert one(spark, ms.average_rate(F.lit("1.1"), F.lit("1.0"))) == Decimal("1.050000")
    bands = ms.receivable_aging(F.lit("100.00"))
    assert [one(spark, c) for c in bands.values()] == [Decimal(x) for x in ("55.00", "25.00", "12.00", "8.00")]
    assert one(spark, ms.inventory_turns(F.lit(10.0), F.lit(0.0))) == 0.0
    assert one(spark, ms.inventory_turns(F.lit(10.0), F.lit(40.0))) == 3.0
    assert one(spark, ms.remaining_spend(F.lit("5.00"), F.lit("7.50"))) == Decimal("-2.50")
    assert one(spark, ms.clamp(F.lit(5.0), 0.3, 1.0)) == 1.0
