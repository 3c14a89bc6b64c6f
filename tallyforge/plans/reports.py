"""Report queries over the KPI tables, with the page filters as parameters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import currency_label, millions_label, percent_label
from tallyforge.operators.ratios import ratio
from tallyforge.plans.metrics import located_forecast

Tables = Mapping[str, DataFrame]

# Guard rails and targets that the reports flag.
MAX_LEVERAGE = 4.0
MIN_COVERAGE = 3.0
AFTERMARKET_TARGET_PCT = 30
BOOK_TO_BILL_PARITY = 1.0
COMPARED_SCENARIOS = ["Actual", "Budget", "Forecast"]
QUARTERS = ["Q1", "Q2", "Q3", "Q4"]


@dataclass(frozen=True)
class ReportFilter:
    """Selections of a report; ``None`` means no restriction, an empty list no rows."""

    business_unit: Sequence[str] | None = None
    region: Sequence[str] | None = None
    fiscal_year: int | None = None
    scenario: str | None = "Actual"

    def _within(self, df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
        if values is None:
            return df
        return df.where(F.col(column).isin(list(values)) if values else F.lit(False))

    def units(self, df: DataFrame) -> DataFrame:
        df = self._within(df, "business_unit", self.business_unit)
        return self._within(df, "region", self.region)

    def year(self, df: DataFrame) -> DataFrame:
        return df if self.fiscal_year is None else df.where(F.col("fiscal_year") == self.fiscal_year)

    def units_year(self, df: DataFrame) -> DataFrame:
        return self.year(self.units(df))

    def all(self, df: DataFrame) -> DataFrame:
        df = self.units_year(df)
        return df if self.scenario is None else df.where(F.col("scenario_name") == self.scenario)

    def actual(self, df: DataFrame) -> DataFrame:
        return self.units_year(df).where(F.col("scenario_name") == "Actual")


# Revenue ------------------------------------------------------------------


def q_rev_by_bu_region(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.actual(tables["gold_revenue_summary"])
        .groupBy("business_unit", "region")
        .agg(F.sum("revenue_usd").alias("revenue"))
        .orderBy(F.desc("revenue"), "business_unit", "region")
    )


def q_rev_quarter_trend(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.actual(tables["gold_revenue_summary"])
        .groupBy("business_unit", "fiscal_quarter")
        .agg(F.sum("revenue_usd").alias("revenue"))
        .orderBy("fiscal_quarter", "business_unit")
    )


def q_yoy_heatmap(tables: Tables, flt: ReportFilter) -> DataFrame:
    """Mean growth per unit, one column per quarter."""
    cells = [
        F.avg(F.when(F.col("fiscal_quarter") == q, F.col("yoy_growth_pct"))).alias(q)
        for q in QUARTERS
    ]
    return (
        flt.actual(tables["gold_revenue_summary"])
        .groupBy("business_unit")
        .agg(*cells)
        .orderBy("business_unit")
    )


def q_scenario_compare(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.units_year(tables["gold_revenue_summary"])
        .where(F.col("scenario_name").isin(COMPARED_SCENARIOS))
        .groupBy("scenario_name", "fiscal_quarter")
        .agg(F.sum("revenue_usd").alias("revenue"))
        .orderBy("fiscal_quarter", "scenario_name")
    )


def q_budget_variance(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.actual(tables["gold_revenue_summary"])
        .groupBy("business_unit")
        .agg(F.avg("budget_variance_pct").alias("budget_variance_pct"))
        .orderBy("budget_variance_pct", "business_unit")
    )


# Profitability --------------------------------------------------------------


def q_ebitda_bridge(tables: Tables, flt: ReportFilter) -> DataFrame:
    measures = ["revenue", "cogs", "opex", "gross_profit", "ebitda"]
    return flt.all(tables["gold_ebitda_bridge"]).agg(*[F.sum(m).alias(m) for m in measures])


def q_ebitda_waterfall(tables: Tables, flt: ReportFilter) -> DataFrame:
    """The bridge as five ordered bars; costs count by size, whatever their sign."""
    bridge = q_ebitda_bridge(tables, flt).select(
        F.col("revenue"), F.abs("cogs").alias("cogs"), F.abs("opex").alias("opex")
    )
    gross = F.col("revenue") - F.col("cogs")
    nothing = F.lit(0).cast("decimal(38,2)")

    def bar(order: int, step: str, kind: str, amount, label):
        return F.struct(
            F.lit(order).alias("step_order"),
            F.lit(step).alias("step"),
            F.lit(kind).alias("measure"),
            amount.cast("decimal(38,2)").alias("amount"),
            label.alias("label"),
        )

    bars = F.array(
        bar(1, "Revenue", "absolute", F.col("revenue"), millions_label(F.col("revenue"))),
        bar(2, "COGS", "relative", -F.col("cogs"), millions_label(F.col("cogs"), True)),
        bar(3, "Gross Profit", "total", nothing, millions_label(gross)),
        bar(4, "OpEx", "relative", -F.col("opex"), millions_label(F.col("opex"), True)),
        bar(5, "EBITDA", "total", nothing, millions_label(gross - F.col("opex"))),
    )
    return bridge.select(F.inline(bars))


def q_margin_trend(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.all(tables["gold_ebitda_bridge"])
        .groupBy("business_unit", "fiscal_quarter")
        .agg(ratio(F.sum("ebitda"), F.sum("revenue")).alias("ebitda_margin"))
        .orderBy("fiscal_quarter", "business_unit")
    )


def q_ebitda_by_bu(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.all(tables["gold_ebitda_bridge"])
        .groupBy("business_unit")
        .agg(F.sum("revenue").alias("revenue"), F.sum("ebitda").alias("ebitda"))
        .withColumn("ebitda_margin", ratio(F.col("ebitda"), F.col("revenue")))
        .orderBy(F.desc("ebitda"), "business_unit")
    )


# Cash, leverage and working capital -------------------------------------------


def q_fcf_by_quarter(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.year(tables["gold_cash_flow_summary"])
        .groupBy("fiscal_quarter")
        .agg(
            *[F.sum(m).alias(m) for m in ("operating_cf", "capex", "fcf")],
            F.avg("fcf_conversion_pct").alias("fcf_conversion_pct"),
        )
        .withColumn("fcf_label", currency_label(F.col("fcf")))
        .orderBy("fiscal_quarter")
    )


def q_cash_kpis(tables: Tables, flt: ReportFilter) -> DataFrame:
    totals = flt.year(tables["gold_cash_flow_summary"]).agg(
        F.sum("operating_cf").alias("operating_cf"),
        F.abs(F.sum("capex")).alias("capex"),
        F.sum("fcf").alias("fcf"),
    )
    return totals.select(
        "*", *[currency_label(F.col(c)).alias(f"{c}_label") for c in totals.columns]
    )


def q_leverage_trend(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.year(tables["gold_leverage_metrics"])
        .groupBy("fiscal_quarter")
        .agg(
            F.avg("net_leverage").alias("net_leverage"),
            F.avg("interest_coverage").alias("interest_coverage"),
        )
        .withColumn("leverage_breach", F.col("net_leverage") > MAX_LEVERAGE)
        .withColumn("coverage_breach", F.col("interest_coverage") < MIN_COVERAGE)
        .orderBy("fiscal_quarter")
    )


def _working_capital(tables: Tables, flt: ReportFilter) -> DataFrame:
    measures = ["dso", "dpo", "inventory_turns", "cash_conversion_cycle"]
    return (
        flt.units_year(tables["gold_working_capital"])
        .groupBy("business_unit", "region")
        .agg(*[F.avg(m).alias(m) for m in measures])
    )


def q_working_capital(tables: Tables, flt: ReportFilter) -> DataFrame:
    return _working_capital(tables, flt).orderBy(F.desc("dso"), "business_unit", "region")


def q_wc_kpis(tables: Tables, flt: ReportFilter) -> DataFrame:
    """Plain mean of the unit-and-region means."""
    measures = ["dso", "dpo", "inventory_turns"]
    kpis = _working_capital(tables, flt).agg(*[F.avg(m).alias(f"avg_{m}") for m in measures])

    def label(pattern: str, column: str, places: int) -> Column:
        return F.format_string(pattern, F.bround(F.col(column).cast("double"), places))

    return kpis.select(
        "*",
        label("%.0f days", "avg_dso", 0).alias("avg_dso_label"),
        label("%.0f days", "avg_dpo", 0).alias("avg_dpo_label"),
        label("%.1fx", "avg_inventory_turns", 1).alias("avg_turns_label"),
    )


# Aftermarket and backlog ------------------------------------------------------


def _aftermarket(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.units_year(tables["gold_aftermarket_mix"])
        .groupBy("business_unit", "region", "fiscal_quarter")
        .agg(
            F.sum("aftermarket_revenue").alias("aftermarket_revenue"),
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("aftermarket_mix_pct").alias("aftermarket_mix_pct"),
            F.avg("service_attach_rate").alias("service_attach_rate"),
        )
    )


def q_aftermarket(tables: Tables, flt: ReportFilter) -> DataFrame:
    return _aftermarket(tables, flt).orderBy("fiscal_quarter", "business_unit", "region")


def q_aftermarket_kpis(tables: Tables, flt: ReportFilter) -> DataFrame:
    kpis = _aftermarket(tables, flt).agg(
        F.sum("aftermarket_revenue").alias("aftermarket_revenue"),
        F.avg("aftermarket_mix_pct").alias("avg_mix_pct"),
        (F.avg("service_attach_rate") * 100).alias("avg_attach_pct"),
    )
    return kpis.select(
        "*",
        currency_label(F.col("aftermarket_revenue")).alias("aftermarket_revenue_label"),
        percent_label(F.col("avg_mix_pct")).alias("avg_mix_label"),
        percent_label(F.col("avg_attach_pct")).alias("avg_attach_label"),
    )


def q_aftermarket_region_mix(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        _aftermarket(tables, flt)
        .groupBy("region")
        .agg(
            F.sum("aftermarket_revenue").alias("aftermarket_revenue"),
            F.sum("total_revenue").alias("total_revenue"),
        )
        .withColumn("mix_pct", ratio(F.col("aftermarket_revenue"), F.col("total_revenue"), 100))
        .withColumn("below_target", F.col("mix_pct") < AFTERMARKET_TARGET_PCT)
        .orderBy("region")
    )


def q_aftermarket_trend(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        _aftermarket(tables, flt)
        .groupBy("fiscal_quarter")
        .agg(F.avg("aftermarket_mix_pct").alias("aftermarket_mix_pct"))
        .orderBy("fiscal_quarter")
    )


def q_attach_by_bu(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        _aftermarket(tables, flt)
        .groupBy("business_unit")
        .agg(F.avg("service_attach_rate").alias("service_attach_rate"))
        .orderBy("business_unit")
    )


def q_book_to_bill(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        flt.units_year(tables["gold_order_backlog"])
        .groupBy("business_unit", "fiscal_month")
        .agg(
            F.sum("order_intake").alias("order_intake"),
            F.sum("backlog_value").alias("backlog_value"),
            F.avg("book_to_bill_ratio").alias("book_to_bill_ratio"),
        )
        .withColumn("below_parity", F.col("book_to_bill_ratio") < BOOK_TO_BILL_PARITY)
        .orderBy("fiscal_month", "business_unit")
    )


# Forecast ------------------------------------------------------------------


def _located_forecast(tables: Tables, flt: ReportFilter) -> DataFrame:
    located = located_forecast(tables["ml_revenue_forecast"], tables["silver_dim_entity"])
    if "product_family" not in located.columns:
        located = located.withColumn("product_family", F.lit(None).cast("string"))
    return flt.units(located)


def forecast_detail(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        _located_forecast(tables, flt)
        .select(
            "business_unit",
            "region",
            "product_family",
            "forecast_month",
            "predicted_revenue",
            "prediction_interval_lower",
            "prediction_interval_upper",
        )
        .orderBy(
            "forecast_month",
            "business_unit",
            "region",
            "product_family",
            "predicted_revenue",
            "prediction_interval_lower",
            "prediction_interval_upper",
        )
    )


def forecast_by_month(tables: Tables, flt: ReportFilter) -> DataFrame:
    return (
        _located_forecast(tables, flt)
        .groupBy("forecast_month")
        .agg(
            F.sum("predicted_revenue").alias("predicted"),
            F.sum("prediction_interval_lower").alias("lower"),
            F.sum("prediction_interval_upper").alias("upper"),
        )
        .orderBy("forecast_month")
    )


def forecast_top3_months(tables: Tables, flt: ReportFilter) -> DataFrame:
    """The next three forecast months, with their display text."""
    months = forecast_by_month(tables, flt).limit(3)
    low, high = currency_label(F.col("lower")), currency_label(F.col("upper"))
    return months.select(
        "*",
        currency_label(F.col("predicted")).alias("predicted_label"),
        F.concat(F.lit("Range: "), low, F.lit(" - "), high).alias("range_label"),
    )


def _forecast_by(tables: Tables, flt: ReportFilter, column: str) -> DataFrame:
    return (
        _located_forecast(tables, flt)
        .groupBy(column, "forecast_month")
        .agg(F.sum("predicted_revenue").alias("predicted"))
        .orderBy("forecast_month", column)
    )


def forecast_by_bu(tables: Tables, flt: ReportFilter) -> DataFrame:
    return _forecast_by(tables, flt, "business_unit")


def forecast_by_region(tables: Tables, flt: ReportFilter) -> DataFrame:
    return _forecast_by(tables, flt, "region")


REPORTS: dict[str, Callable[[Tables, ReportFilter], DataFrame]] = {
    fn.__name__: fn
    for fn in [
        q_rev_by_bu_region,
        q_rev_quarter_trend,
        q_yoy_heatmap,
        q_scenario_compare,
        q_budget_variance,
        q_ebitda_bridge,
        q_ebitda_waterfall,
        q_margin_trend,
        q_ebitda_by_bu,
        q_fcf_by_quarter,
        q_cash_kpis,
        q_leverage_trend,
        q_working_capital,
        q_wc_kpis,
        q_aftermarket,
        q_aftermarket_kpis,
        q_aftermarket_region_mix,
        q_aftermarket_trend,
        q_attach_by_bu,
        q_book_to_bill,
        forecast_detail,
        forecast_by_month,
        forecast_top3_months,
        forecast_by_bu,
        forecast_by_region,
    ]
}


def report(name: str, tables: Tables, flt: ReportFilter | None = None) -> DataFrame:
    """Run one report by name."""
    return REPORTS[name](tables, flt or ReportFilter())
