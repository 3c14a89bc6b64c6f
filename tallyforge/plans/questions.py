"""The standing analyst questions as parameterised queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.periods import at_latest, last_months, last_quarters
from tallyforge.operators.ratios import growth_pct, ratio
from tallyforge.plans.gold import YEAR_QUARTER

Tables = Mapping[str, DataFrame]


def nlq_rev_q4_yoy(
    tables: Tables, fiscal_year: int, quarter: str = "Q4", scenario: str = "Actual"
) -> DataFrame:
    """Revenue by unit in one quarter against the same quarter a year earlier."""
    year = F.col("fiscal_year")
    rows = tables["gold_revenue_summary"].where(
        (F.col("scenario_name") == scenario)
        & (F.col("fiscal_quarter") == quarter)
        & year.isin([fiscal_year, fiscal_year - 1])
    )
    return (
        rows.groupBy("business_unit")
        .agg(
            F.sum(F.when(year == fiscal_year, F.col("revenue_usd"))).alias("revenue"),
            F.sum(F.when(year == fiscal_year - 1, F.col("revenue_usd"))).alias("prior_revenue"),
        )
        .withColumn("growth_pct", growth_pct(F.col("revenue"), F.col("prior_revenue")))
        .orderBy("business_unit")
    )


def nlq_margin_8q(tables: Tables, quarters: int = 8, scenario: str = "Actual") -> DataFrame:
    """EBITDA margin by region over the last quarters."""
    rows = tables["gold_ebitda_bridge"].where(F.col("scenario_name") == scenario)
    return (
        last_quarters(rows, quarters)
        .groupBy("region", *YEAR_QUARTER)
        .agg(ratio(F.sum("ebitda"), F.sum("revenue")).alias("ebitda_margin"))
        .orderBy(*YEAR_QUARTER, "region")
    )


def nlq_leverage_8q(tables: Tables, quarters: int = 8) -> DataFrame:
    """Leverage and coverage of the whole company over the last quarters."""
    return (
        last_quarters(tables["gold_leverage_metrics"], quarters)
        .groupBy(*YEAR_QUARTER)
        .agg(
            ratio(F.sum("net_debt"), F.sum("ltm_ebitda")).alias("net_leverage"),
            ratio(F.sum("ltm_ebitda"), F.sum("total_interest")).alias("interest_coverage"),
        )
        .orderBy(*YEAR_QUARTER)
    )


def nlq_top_dso(tables: Tables, top: int = 10) -> DataFrame:
    """Entities with the highest mean DSO in the latest quarter."""
    return (
        last_quarters(tables["gold_working_capital"])
        .groupBy("entity_name", *YEAR_QUARTER)
        .agg(F.avg("dso").alias("dso"))
        .orderBy(F.desc("dso"), "entity_name")
        .limit(top)
    )


def nlq_mix_below_30(tables: Tables, target_pct: float = 30) -> DataFrame:
    """Aftermarket mix by region in the latest quarter, flagged against the target."""
    return (
        last_quarters(tables["gold_aftermarket_mix"])
        .groupBy("region", *YEAR_QUARTER)
        .agg(
            ratio(F.sum("aftermarket_revenue"), F.sum("total_revenue"), 100).alias("mix_pct")
        )
        .withColumn("below_target", F.col("mix_pct") < target_pct)
        .orderBy("region")
    )


def nlq_plants_under_70(tables: Tables, threshold: float = 0.70) -> DataFrame:
    """Plants below the utilisation threshold in the latest quarter."""
    return (
        last_quarters(tables["gold_plant_performance"])
        .where(F.col("utilization_pct") < threshold)
        .select("plant_id", "plant_name", *YEAR_QUARTER, "utilization_pct")
        .orderBy("utilization_pct", "plant_id")
    )


def nlq_b2b_6m(tables: Tables, months: int = 6) -> DataFrame:
    """Book-to-bill by unit and month over the last months."""
    grain = ["fiscal_year", "fiscal_month", "business_unit"]
    return (
        last_months(tables["gold_order_backlog"], months)
        .groupBy(*grain)
        .agg(ratio(F.sum("order_intake"), F.sum("shipped_revenue")).alias("book_to_bill_ratio"))
        .orderBy(*grain)
    )


def nlq_top_family(tables: Tables, top: int = 10) -> DataFrame:
    """Families with the highest prediction in the latest forecast month."""
    return (
        at_latest(tables["ml_revenue_forecast"], "forecast_month")
        .groupBy("product_family", "forecast_month")
        .agg(F.sum("predicted_revenue").alias("predicted"))
        .orderBy(F.desc("predicted"), "product_family")
        .limit(top)
    )


QUESTIONS: dict[str, Callable[..., DataFrame]] = {
    fn.__name__: fn
    for fn in [
        nlq_rev_q4_yoy,
        nlq_margin_8q,
        nlq_leverage_8q,
        nlq_top_dso,
        nlq_mix_below_30,
        nlq_plants_under_70,
        nlq_b2b_6m,
        nlq_top_family,
    ]
}
