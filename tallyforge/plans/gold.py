"""KPI tables.

Every function takes cleaned tables and returns one KPI table. Facts meet
dimensions through plain equi-joins: the planner broadcasts a dimension when
its size is under the threshold and shuffles both sides, with skewed partitions
split, when it is not. All group-bys aggregate inside the map tasks first, so a
group that holds a third of the fact reaches the shuffle as one row per task.

Money and means of decimals stay exact decimals, so averaging them again does
not depend on row order; ratios are doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.calendar import quarter_index
from tallyforge.operators.periods import prior_year_value, scenario_value
from tallyforge.operators.ratios import exact_mean, growth_pct, ratio

YEAR_QUARTER = ["fiscal_year", "fiscal_quarter"]
YEAR_QUARTER_MONTH = [*YEAR_QUARTER, "fiscal_month"]
# Fixed values.
LTM_EBITDA = 350_000_000
CASH_CYCLE_OFFSET_DAYS = 30


def sum_where(condition: Column, column: str) -> Column:
    """Sum over matching rows, NULL when no row matches (as a pivot cell is)."""
    return F.sum(F.when(condition, F.col(column)))


def _in_periods(fact: DataFrame, time: DataFrame, periods: Sequence[str]) -> DataFrame:
    return fact.join(time.select("time_id", *periods), "time_id")


def _of_entities(fact: DataFrame, entity: DataFrame, attributes: Sequence[str]) -> DataFrame:
    return fact.join(entity.select("entity_id", *attributes), "entity_id")


def monthly_revenue(
    gl: DataFrame, account: DataFrame, entity: DataFrame, time: DataFrame, scenario: DataFrame
) -> DataFrame:
    """Revenue by business unit, region, month and scenario."""
    revenue_accounts = account.where(F.col("account_type") == "Revenue").select("account_id")
    journal = gl.select("account_id", "entity_id", "time_id", "scenario_id", "amount_usd")
    rows = journal.join(revenue_accounts, "account_id")
    rows = _of_entities(rows, entity, ["business_unit", "region"])
    rows = _in_periods(rows, time, YEAR_QUARTER_MONTH)
    rows = rows.join(scenario.select("scenario_id", "scenario_name"), "scenario_id")
    return rows.groupBy("business_unit", "region", *YEAR_QUARTER_MONTH, "scenario_name").agg(
        F.sum("amount_usd").alias("revenue_usd")
    )


def _by_unit_and_month(revenue: DataFrame) -> DataFrame:
    # One shuffle of the (small) aggregate serves both look-up windows.
    return revenue.repartition("business_unit", "region", "fiscal_month")


def with_prior_year(revenue: DataFrame) -> DataFrame:
    """Add prior-year revenue and growth in percent."""
    keys = ["business_unit", "region", "fiscal_month", "scenario_name"]
    out = revenue.withColumn("py_revenue", prior_year_value("revenue_usd", keys))
    return out.withColumn("yoy_growth_pct", growth_pct(F.col("revenue_usd"), F.col("py_revenue")))


def with_budget(revenue: DataFrame) -> DataFrame:
    """Add the budget of the same month to every scenario, and the variance in percent."""
    keys = ["business_unit", "region", "fiscal_year", "fiscal_month"]
    out = revenue.withColumn("budget_revenue", scenario_value("revenue_usd", "Budget", keys))
    return out.withColumn(
        "budget_variance_pct", growth_pct(F.col("revenue_usd"), F.col("budget_revenue"))
    )


def yoy_growth(*star: DataFrame) -> DataFrame:
    return with_prior_year(_by_unit_and_month(monthly_revenue(*star)))


def budget_variance(*star: DataFrame) -> DataFrame:
    return with_budget(_by_unit_and_month(monthly_revenue(*star)))


def gold_revenue_summary(
    gl: DataFrame, account: DataFrame, entity: DataFrame, time: DataFrame, scenario: DataFrame
) -> DataFrame:
    """Revenue with year-over-year growth and budget variance."""
    revenue = _by_unit_and_month(monthly_revenue(gl, account, entity, time, scenario))
    return with_budget(with_prior_year(revenue)).drop("py_revenue", "budget_revenue")


def gold_ebitda_bridge(
    gl: DataFrame, account: DataFrame, entity: DataFrame, time: DataFrame, scenario: DataFrame
) -> DataFrame:
    """Revenue through cost categories to EBITDA.

    A group with only other account types stays, with NULL measures.
    """
    journal = gl.select("account_id", "entity_id", "time_id", "scenario_id", "amount_usd")
    rows = journal.join(account.select("account_id", "account_type"), "account_id")
    rows = _of_entities(rows, entity, ["business_unit", "region"])
    rows = _in_periods(rows, time, YEAR_QUARTER)
    rows = rows.join(scenario.select("scenario_id", "scenario_name"), "scenario_id")
    kind = F.col("account_type")
    bridge = rows.groupBy("business_unit", "region", *YEAR_QUARTER, "scenario_name").agg(
        sum_where(kind == "Revenue", "amount_usd").alias("revenue"),
        sum_where(kind == "COGS", "amount_usd").alias("cogs"),
        sum_where(kind == "OpEx", "amount_usd").alias("opex"),
    )
    nothing = F.lit(0).cast("decimal(28,2)")
    gross = F.col("revenue") - F.coalesce("cogs", nothing)
    return (
        bridge.withColumn("gross_profit", gross.cast("decimal(28,2)"))
        .withColumn(
            "ebitda",
            (F.col("gross_profit") - F.coalesce("opex", nothing)).cast("decimal(28,2)"),
        )
        .withColumn("ebitda_margin", ratio(F.col("ebitda"), F.col("revenue")))
    )


def gold_cash_flow_summary(
    gl: DataFrame,
    account: DataFrame,
    entity: DataFrame,
    time: DataFrame,
    scenario: DataFrame | None = None,
    scenario_name: str | None = None,
    by_scenario: bool = False,
) -> DataFrame:
    """Operating, investing and financing cash flow, free cash flow and conversion.

    All scenarios are summed unless ``scenario_name`` picks one or
    ``by_scenario`` adds the scenario to the grain. ``fcf`` adds capital
    spending, so spending must carry a negative sign. Conversion is free cash
    flow over operating cash flow.
    """
    flows = account.where(F.col("account_type") == "CF").select("account_id", "account_group")
    columns = ["account_id", "entity_id", "time_id", "amount_usd"]
    grain = ["entity_name", "region", *YEAR_QUARTER]
    split = scenario_name is not None or by_scenario
    rows = gl.select(*columns, *(["scenario_id"] if split else [])).join(flows, "account_id")
    rows = _of_entities(rows, entity, ["entity_name", "region"])
    rows = _in_periods(rows, time, YEAR_QUARTER)
    if split:
        names = scenario.select("scenario_id", "scenario_name")
        if scenario_name is not None:
            names = names.where(F.col("scenario_name") == scenario_name)
        rows = rows.join(names, "scenario_id")
        if by_scenario:
            grain.append("scenario_name")
    group = F.col("account_group")
    cash = rows.groupBy(*grain).agg(
        sum_where(group == "CF_OPS", "amount_usd").alias("operating_cf"),
        sum_where(group == "CF_INV", "amount_usd").alias("capex"),
        sum_where(group == "CF_FIN", "amount_usd").alias("financing_cf"),
    )
    nothing = F.lit(0).cast("decimal(28,2)")
    fcf = F.coalesce("operating_cf", nothing) + F.coalesce("capex", nothing)
    return cash.withColumn("fcf", fcf.cast("decimal(28,2)")).withColumn(
        "fcf_conversion_pct", ratio(F.col("fcf"), F.col("operating_cf"), 100)
    )


def trailing_year_ebitda(bridge: DataFrame, scenario_name: str = "Actual") -> DataFrame:
    """EBITDA of the four quarters that end with each quarter.

    Every quarter adds its figure to itself and the next three, which needs a
    group-by but no ordered pass over all quarters.
    """
    quarters = (
        bridge.where(F.col("scenario_name") == scenario_name)
        .groupBy(quarter_index(F.col("fiscal_year"), F.col("fiscal_quarter")).alias("q"))
        .agg(F.sum("ebitda").alias("ebitda"))
    )
    return (
        quarters.select(F.explode(F.sequence(F.col("q"), F.col("q") + 3)).alias("q"), "ebitda")
        .groupBy("q")
        .agg(F.sum("ebitda").alias("ltm_ebitda"))
    )


def gold_leverage_metrics(
    debt: DataFrame,
    time: DataFrame,
    ltm_ebitda: int = LTM_EBITDA,
    balance: str = "sum",
    bridge: DataFrame | None = None,
) -> DataFrame:
    """Net debt, interest, leverage and coverage by entity and quarter.

    ``balance="sum"`` adds the monthly balances of a quarter; ``"period_end"``
    takes the last month that the entity reports in it. ``bridge`` replaces the
    constant EBITDA by the trailing four quarters of that table.
    """
    columns = ["entity_id", "time_id", "principal_balance", "interest_expense"]
    rows = debt.select(*columns)
    grain = ["entity_id", *YEAR_QUARTER]
    if balance == "sum":
        figures = (
            _in_periods(rows, time, YEAR_QUARTER)
            .groupBy(*grain)
            .agg(
                F.sum("principal_balance").alias("net_debt"),
                F.sum("interest_expense").alias("total_interest"),
            )
        )
    elif balance == "period_end":
        months = (
            _in_periods(rows, time, YEAR_QUARTER_MONTH)
            .groupBy(*grain, "fiscal_month")
            .agg(F.sum("principal_balance").alias("debt"), F.sum("interest_expense").alias("paid"))
        )
        figures = months.groupBy(*grain).agg(
            F.max_by("debt", "fiscal_month").alias("net_debt"),
            F.sum("paid").cast("decimal(28,2)").alias("total_interest"),
        )
    else:
        raise ValueError(f"balance must be 'sum' or 'period_end', not {balance!r}")
    if bridge is None:
        figures = figures.withColumn("ltm_ebitda", F.lit(ltm_ebitda).cast("decimal(28,2)"))
    else:
        figures = (
            figures.withColumn("q", quarter_index(F.col("fiscal_year"), F.col("fiscal_quarter")))
            .join(trailing_year_ebitda(bridge), "q", "left")
            .select(*figures.columns, F.col("ltm_ebitda").cast("decimal(28,2)"))
        )
    return figures.withColumn(
        "net_leverage", ratio(F.col("net_debt"), F.col("ltm_ebitda"))
    ).withColumn(
        "interest_coverage",
        ratio(F.col("ltm_ebitda"), F.col("total_interest"), positive_only=True),
    )


def gold_working_capital(
    wc: DataFrame,
    entity: DataFrame,
    time: DataFrame,
    offset_days: int = CASH_CYCLE_OFFSET_DAYS,
) -> DataFrame:
    """Mean DSO, DPO, inventory turns and the cash conversion cycle."""
    rows = wc.select("entity_id", "time_id", "dso", "dpo", "inventory_turns")
    rows = _of_entities(rows, entity, ["entity_name", "business_unit", "region"])
    rows = _in_periods(rows, time, YEAR_QUARTER_MONTH)
    return (
        rows.groupBy("entity_name", "business_unit", "region", *YEAR_QUARTER_MONTH)
        .agg(*[F.avg(c).alias(c) for c in ("dso", "dpo", "inventory_turns")])
        .withColumn("cash_conversion_cycle", F.col("dso") - F.col("dpo") + F.lit(offset_days))
    )


def gold_aftermarket_mix(
    service: DataFrame, orders: DataFrame, entity: DataFrame, time: DataFrame
) -> DataFrame:
    """Aftermarket revenue against order revenue, and the service attach rate."""
    grain = ["business_unit", "region", *YEAR_QUARTER]

    def located(fact: DataFrame, *columns: str) -> DataFrame:
        rows = fact.select("entity_id", "time_id", *columns)
        rows = _of_entities(rows, entity, ["business_unit", "region"])
        return _in_periods(rows, time, YEAR_QUARTER).groupBy(*grain)

    contracts = located(service, "contract_value_usd", "service_attach_flag").agg(
        F.sum("contract_value_usd").alias("aftermarket_revenue"),
        exact_mean(F.col("service_attach_flag").cast("int")).alias("service_attach_rate"),
    )
    ordered = located(orders, "net_amount_usd").agg(F.sum("net_amount_usd").alias("total_revenue"))
    mix = ratio(F.col("aftermarket_revenue"), F.col("total_revenue"), 100, positive_only=True)
    return contracts.join(ordered, grain, "left").withColumn("aftermarket_mix_pct", mix)


def gold_order_backlog(orders: DataFrame, entity: DataFrame, time: DataFrame) -> DataFrame:
    """Order intake, open backlog, shipped revenue and book-to-bill by month."""
    rows = orders.select("entity_id", "time_id", "net_amount_usd", "backlog_flag", "order_status")
    rows = _of_entities(rows, entity, ["business_unit", "region"])
    rows = _in_periods(rows, time, YEAR_QUARTER_MONTH)
    nothing = F.lit(0).cast("decimal(18,2)")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("net_amount_usd")).otherwise(nothing))

    intake = ratio(F.col("order_intake"), F.col("shipped_revenue"), positive_only=True)
    return (
        rows.groupBy("business_unit", "region", *YEAR_QUARTER_MONTH)
        .agg(
            F.sum("net_amount_usd").alias("order_intake"),
            total(F.col("backlog_flag")).alias("backlog_value"),
            total(F.col("order_status") == "Shipped").alias("shipped_revenue"),
        )
        .withColumn("book_to_bill_ratio", intake)
    )


def gold_plant_performance(
    production: DataFrame, cost_center: DataFrame, time: DataFrame
) -> DataFrame:
    """Utilisation, cost variance, scrap and units by plant and quarter.

    A row with zero standard cost has no variance and is left out of that mean.
    """
    measures = ["utilization_pct", "actual_cost", "standard_cost", "scrap_rate", "units_produced"]
    plants = cost_center.select("cost_center_id", "plant_id", "plant_name", "plant_country")
    rows = production.select("cost_center_id", "time_id", *measures).join(plants, "cost_center_id")
    rows = _in_periods(rows, time, YEAR_QUARTER)
    variance = growth_pct(F.col("actual_cost"), F.col("standard_cost"))
    return rows.groupBy("plant_id", "plant_name", "plant_country", *YEAR_QUARTER).agg(
        F.avg("utilization_pct").alias("utilization_pct"),
        F.avg(variance).alias("cost_variance_pct"),
        F.avg("scrap_rate").alias("scrap_rate"),
        F.sum("units_produced").alias("total_units"),
    )
