"""Metric views: measures that are computed from source rows at the asked grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.calendar import period_key
from tallyforge.operators.ratios import ratio_of_sums


@dataclass(frozen=True)
class MetricView:
    """A source table with named dimensions and named measures (SQL expressions)."""

    name: str
    source: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]

    def query(
        self,
        tables: Mapping[str, DataFrame] | DataFrame,
        dims: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: Column | str | None = None,
    ) -> DataFrame:
        """Group the source by ``dims`` and compute ``measures`` there.

        ``where`` filters source rows, so it reaches the scan.
        """
        source = tables if isinstance(tables, DataFrame) else tables[self.source]
        chosen = self._chosen(dims, measures)
        if where is not None:
            source = source.where(where)
        grouping = [F.expr(self.dimensions[d]).alias(d) for d in dims]
        return source.groupBy(*grouping).agg(
            *[F.expr(self.measures[m]).alias(m) for m in chosen]
        )

    def statement(self, dims: Sequence[str] = (), measures: Sequence[str] | None = None) -> str:
        """``query`` as SQL text for ``Warehouse.query``, with the source's short name in braces."""
        columns = [f"{self.dimensions[d]} AS `{d}`" for d in dims]
        columns += [f"{self.measures[m]} AS `{m}`" for m in self._chosen(dims, measures)]
        groups = f" GROUP BY {', '.join(str(k + 1) for k in range(len(dims)))}" if dims else ""
        return f"SELECT {', '.join(columns)} FROM {{{self.source}}}{groups}"

    def _chosen(self, dims: Sequence[str], measures: Sequence[str] | None) -> list[str]:
        chosen = list(measures) if measures is not None else list(self.measures)
        unknown = [d for d in dims if d not in self.dimensions]
        unknown += [m for m in chosen if m not in self.measures]
        if unknown:
            raise KeyError(f"{self.name} has no {', '.join(unknown)}")
        return chosen


def located_forecast(forecast: DataFrame, entity: DataFrame) -> DataFrame:
    """The forecast with unit and region; what its series keys lack of them comes from the entity."""
    lacking = [c for c in ("business_unit", "region") if c not in forecast.columns]
    return forecast.join(entity.select("entity_id", *lacking), "entity_id") if lacking else forecast


def forecast_with_actuals(
    forecast: DataFrame, entity: DataFrame, revenue: DataFrame
) -> DataFrame:
    """Each forecast row beside the actual revenue of its unit, region and month.

    One actual stands beside every forecast row of its group, so its sum counts
    it once per row; ``forecast_accuracy_aligned`` compares equal grains.
    """
    actual = revenue.where(F.col("scenario_name") == "Actual").select(
        "business_unit",
        "region",
        period_key(F.col("fiscal_year"), F.col("fiscal_month")).alias("forecast_month"),
        F.col("revenue_usd").alias("actual_revenue"),
    )
    grain = ["business_unit", "region", "forecast_month"]
    located = located_forecast(forecast, entity)
    return located.select(
        *[c for c in located.columns if c == "entity_id"], *grain, "predicted_revenue"
    ).join(actual, grain, "left")


def forecast_accuracy_aligned(
    forecast: DataFrame, entity: DataFrame, revenue: DataFrame
) -> DataFrame:
    """Predictions summed to unit, region and month, then set against actuals."""
    grain = ["business_unit", "region", "forecast_month"]
    predicted = (
        located_forecast(forecast, entity)
        .groupBy(*grain)
        .agg(F.sum("predicted_revenue").alias("predicted_revenue"))
    )
    actual = (
        revenue.where(F.col("scenario_name") == "Actual")
        .withColumn("forecast_month", period_key(F.col("fiscal_year"), F.col("fiscal_month")))
        .groupBy(*grain)
        .agg(F.sum("revenue_usd").alias("actual_revenue"))
    )
    return predicted.join(actual, grain, "left")


# Dimension and measure names of the eight views.
BY_UNIT = {"Business Unit": "business_unit", "Region": "region"}
BY_QUARTER = {"Fiscal Year": "fiscal_year", "Fiscal Quarter": "fiscal_quarter"}
MAPE = (
    "AVG(ABS(CAST(predicted_revenue AS DOUBLE) - CAST(actual_revenue AS DOUBLE))"
    " / NULLIF(CAST(actual_revenue AS DOUBLE), 0)) * 100"
)

METRIC_VIEWS: dict[str, MetricView] = {
    view.name: view
    for view in [
        MetricView(
            "mv_revenue",
            "gold_revenue_summary",
            {
                **BY_UNIT,
                **BY_QUARTER,
                "Fiscal Month": "fiscal_month",
                "Scenario": "scenario_name",
            },
            {
                "Revenue": "SUM(revenue_usd)",
                "YoY Growth Pct": "AVG(yoy_growth_pct)",
                "Budget Variance Pct": "AVG(budget_variance_pct)",
            },
        ),
        MetricView(
            "mv_ebitda",
            "gold_ebitda_bridge",
            {**BY_UNIT, **BY_QUARTER, "Scenario": "scenario_name"},
            {
                "Revenue": "SUM(revenue)",
                "COGS": "SUM(cogs)",
                "Gross Profit": "SUM(gross_profit)",
                "OpEx": "SUM(opex)",
                "EBITDA": "SUM(ebitda)",
                "EBITDA Margin": ratio_of_sums("ebitda", "revenue"),
            },
        ),
        MetricView(
            "mv_free_cash_flow",
            "gold_cash_flow_summary",
            {"Entity": "entity_name", "Region": "region", **BY_QUARTER},
            {
                "Operating Cash Flow": "SUM(operating_cf)",
                "CapEx": "SUM(capex)",
                "Free Cash Flow": "SUM(fcf)",
                "FCF Conversion Pct": ratio_of_sums("fcf", "operating_cf", 100),
            },
        ),
        MetricView(
            "mv_leverage",
            "gold_leverage_metrics",
            {"Entity": "entity_id", **BY_QUARTER},
            {
                "Net Debt": "SUM(net_debt)",
                "Net Leverage Ratio": ratio_of_sums("net_debt", "ltm_ebitda"),
                "Interest Coverage Ratio": ratio_of_sums("ltm_ebitda", "total_interest"),
            },
        ),
        MetricView(
            "mv_working_capital",
            "gold_working_capital",
            {"Entity": "entity_name", **BY_UNIT, **BY_QUARTER},
            {
                "DSO": "AVG(dso)",
                "DPO": "AVG(dpo)",
                "Inventory Turns": "AVG(inventory_turns)",
                "Cash Conversion Cycle": "AVG(cash_conversion_cycle)",
            },
        ),
        MetricView(
            "mv_aftermarket",
            "gold_aftermarket_mix",
            {**BY_UNIT, **BY_QUARTER},
            {
                "Aftermarket Revenue": "SUM(aftermarket_revenue)",
                "Total Revenue": "SUM(total_revenue)",
                "Aftermarket Mix Pct": ratio_of_sums("aftermarket_revenue", "total_revenue", 100),
                "Service Attach Rate": "AVG(service_attach_rate)",
            },
        ),
        MetricView(
            "mv_order_backlog",
            "gold_order_backlog",
            {**BY_UNIT, "Fiscal Year": "fiscal_year", "Fiscal Month": "fiscal_month"},
            {
                "Order Intake": "SUM(order_intake)",
                "Backlog Value": "SUM(backlog_value)",
                "Book-to-Bill Ratio": ratio_of_sums("order_intake", "shipped_revenue"),
            },
        ),
        MetricView(
            "mv_forecast_accuracy",
            "forecast_with_actuals",
            {**BY_UNIT, "Forecast Month": "forecast_month"},
            {
                "Predicted Revenue": "SUM(predicted_revenue)",
                "Actual Revenue": "SUM(actual_revenue)",
                "MAPE": MAPE,
            },
        ),
    ]
}


# KPIs that both the gold tables and the metric views serve: gold aggregate
# against view and measure.
def _parity_checks() -> list[tuple[str, str, Column, str, str]]:
    def total(column: str) -> Column:
        return F.sum(column).cast("double")

    return [
        ("revenue", "gold_revenue_summary", total("revenue_usd"), "mv_revenue", "Revenue"),
        ("ebitda", "gold_ebitda_bridge", total("ebitda"), "mv_ebitda", "EBITDA"),
        (
            "ebitda_margin",
            "gold_ebitda_bridge",
            F.try_divide(total("ebitda"), total("revenue")),
            "mv_ebitda",
            "EBITDA Margin",
        ),
        (
            "dso",
            "gold_working_capital",
            F.avg("dso").cast("double"),
            "mv_working_capital",
            "DSO",
        ),
        (
            "aftermarket_mix_pct",
            "gold_aftermarket_mix",
            F.try_divide(total("aftermarket_revenue"), total("total_revenue")) * 100,
            "mv_aftermarket",
            "Aftermarket Mix Pct",
        ),
        (
            "book_to_bill",
            "gold_order_backlog",
            F.try_divide(total("order_intake"), total("shipped_revenue")),
            "mv_order_backlog",
            "Book-to-Bill Ratio",
        ),
    ]


def metric_parity(tables: Mapping[str, DataFrame], tolerance: float = 1e-9) -> DataFrame:
    """The same KPI by fiscal year from both paths, and whether they agree."""
    parts = []
    for kpi, gold, direct, view, measure in _parity_checks():
        source = tables[gold]
        left = source.groupBy("fiscal_year").agg(direct.alias("gold_value"))
        right = METRIC_VIEWS[view].query(source, ["Fiscal Year"], [measure])
        right = right.select(
            F.col("Fiscal Year").alias("fiscal_year"),
            F.col(f"`{measure}`").cast("double").alias("metric_value"),
        )
        gap = F.abs(F.col("gold_value") - F.col("metric_value"))
        agree = gap <= tolerance * F.greatest(F.abs("gold_value"), F.lit(1.0))
        both_missing = F.col("gold_value").isNull() & F.col("metric_value").isNull()
        parts.append(
            left.join(right, "fiscal_year", "full").select(
                F.lit(kpi).alias("kpi"),
                "fiscal_year",
                "gold_value",
                "metric_value",
                F.coalesce(agree, both_missing).alias("matches"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


