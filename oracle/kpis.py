"""KPI tables, metric views, reports, questions and forecast features."""

from oracle.parts import mean_of, mean_units

TRUSTED = "fiscal_year = 2000"
UNITS = "business_unit IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"
REGIONS = "region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"
HERE = f"{UNITS} AND {REGIONS}"
HERE_NOW = f"{HERE} AND {TRUSTED}"
ACTUAL = f"{HERE_NOW} AND scenario_name = 'Actual'"


def _sum(column: str, name: str | None = None) -> str:
    return f'CAST(SUM({column}) AS DOUBLE) AS "{name or column}"'


def _avg(column: str, name: str | None = None, scale: str = "") -> str:
    return f'round(AVG({column}){scale}, 6) AS "{name or column}"'


def _rate(num: str, den: str, name: str, scale: str = "") -> str:
    return (
        f"round(CAST(SUM({num}) AS DOUBLE) / nullif(CAST(SUM({den}) AS DOUBLE), 0){scale}, 6)"
        f' AS "{name}"'
    )


def _mean_again(column: str, scale: int) -> str:
    """Mean of whole units of ten to the minus ``scale``, with four more places."""
    units = mean_units(f"(SUM({column})::HUGEINT * 10000)", "COUNT(*)")
    return f"CAST({units} AS DOUBLE) / {10 ** (scale + 4)}"


def _money_label(column: str) -> str:
    """Magnitude text of a sum that has no tie at its first decimal."""
    c = f"CAST({column} AS DOUBLE)"
    return (
        f"CASE WHEN abs({c}) >= 1e9 THEN printf('$%.1fB', {c} / 1e9)"
        f" WHEN abs({c}) >= 1e6 THEN printf('$%.1fM', {c} / 1e6)"
        f" WHEN abs({c}) >= 1e3 THEN printf('$%.1fK', {c} / 1e3)"
        f" ELSE printf('$%.0f', {c}) END"
    )


GOLD = {
    "yoy_growth": """
SELECT business_unit, region, fiscal_year, fiscal_quarter, fiscal_month, scenario_name,
       CAST(revenue_usd AS DOUBLE) AS revenue_usd, CAST(py_revenue AS DOUBLE) AS py_revenue,
       round(yoy_growth_pct, 6) AS yoy_growth_pct
FROM x_revenue_summary
""",
    "budget_variance": """
SELECT business_unit, region, fiscal_year, fiscal_quarter, fiscal_month, scenario_name,
       CAST(revenue_usd AS DOUBLE) AS revenue_usd, CAST(budget_revenue AS DOUBLE) AS budget_revenue,
       round(budget_variance_pct, 6) AS budget_variance_pct
FROM x_revenue_summary
""",
    "gold_revenue_summary": """
SELECT business_unit, region, fiscal_year, fiscal_quarter, fiscal_month, scenario_name,
       CAST(revenue_usd AS DOUBLE) AS revenue_usd,
       round(yoy_growth_pct, 6) AS yoy_growth_pct,
       round(budget_variance_pct, 6) AS budget_variance_pct
FROM x_revenue_summary
""",
    "gold_ebitda_bridge": """
SELECT business_unit, region, fiscal_year, fiscal_quarter, scenario_name,
       CAST(revenue AS DOUBLE) AS revenue, CAST(cogs AS DOUBLE) AS cogs, CAST(opex AS DOUBLE) AS opex,
       CAST(gross_profit AS DOUBLE) AS gross_profit, CAST(ebitda AS DOUBLE) AS ebitda,
       CASE WHEN revenue <> 0 THEN round(CAST(ebitda AS DOUBLE) / CAST(revenue AS DOUBLE), 6) END
         AS ebitda_margin
FROM x_bridge
""",
    "gold_cash_flow_summary": """
SELECT entity_name, region, fiscal_year, fiscal_quarter,
       CAST(operating_cf AS DOUBLE) AS operating_cf, CAST(capex AS DOUBLE) AS capex,
       CAST(financing_cf AS DOUBLE) AS financing_cf, CAST(fcf AS DOUBLE) AS fcf,
       round(fcf_conversion_pct, 6) AS fcf_conversion_pct
FROM x_cash
""",
    "gold_cash_flow_actual": """
SELECT entity_name, region, fiscal_year, fiscal_quarter,
       CAST(o AS DOUBLE) AS operating_cf, CAST(i AS DOUBLE) AS capex, CAST(f AS DOUBLE) AS financing_cf,
       CAST(coalesce(o, 0) + coalesce(i, 0) AS DOUBLE) AS fcf,
       CASE WHEN o <> 0 THEN
         round(CAST(coalesce(o, 0) + coalesce(i, 0) AS DOUBLE) / CAST(o AS DOUBLE) * 100, 6) END
         AS fcf_conversion_pct
FROM (
  SELECT entity_name, region, fiscal_year, fiscal_quarter,
         SUM(CASE WHEN flow = 'CF_OPS' THEN amount_usd END) AS o,
         SUM(CASE WHEN flow = 'CF_INV' THEN amount_usd END) AS i,
         SUM(CASE WHEN flow = 'CF_FIN' THEN amount_usd END) AS f
  FROM x_cash_rows WHERE scenario_name = 'Actual' GROUP BY ALL)
""",
    "gold_leverage_metrics": """
SELECT entity_id, fiscal_year, fiscal_quarter, CAST(net_debt AS DOUBLE) AS net_debt,
       CAST(total_interest AS DOUBLE) AS total_interest, ltm_ebitda,
       round(net_leverage, 6) AS net_leverage, round(interest_coverage, 6) AS interest_coverage
FROM x_leverage
""",
    "gold_leverage_period_end": """
SELECT entity_id, fiscal_year, fiscal_quarter, CAST(debt AS DOUBLE) AS net_debt,
       CAST(interest AS DOUBLE) AS total_interest, CAST(ltm AS DOUBLE) AS ltm_ebitda,
       CASE WHEN ltm <> 0 THEN round(CAST(debt AS DOUBLE) / CAST(ltm AS DOUBLE), 6) END AS net_leverage,
       CASE WHEN interest > 0 THEN round(CAST(ltm AS DOUBLE) / CAST(interest AS DOUBLE), 6) END
         AS interest_coverage
FROM (
  SELECT entity_id, fiscal_year, fiscal_quarter, SUM(interest) AS interest,
         SUM(principal) FILTER (WHERE fiscal_month = last_month) AS debt
  FROM (SELECT *, max(fiscal_month) OVER (PARTITION BY entity_id, fiscal_year, fiscal_quarter)
          AS last_month FROM x_debt)
  GROUP BY ALL)
LEFT JOIN (
  SELECT a.fiscal_year, a.fiscal_quarter, SUM(b.ebitda) AS ltm
  FROM (SELECT DISTINCT fiscal_year, fiscal_quarter,
               fiscal_year * 4 + CAST(fiscal_quarter[2:] AS INT) AS q FROM x_debt) a
  JOIN (SELECT fiscal_year * 4 + CAST(fiscal_quarter[2:] AS INT) AS q, ebitda
        FROM x_bridge WHERE scenario_name = 'Actual') b ON b.q BETWEEN a.q - 3 AND a.q
  GROUP BY ALL) USING (fiscal_year, fiscal_quarter)
""",
    "gold_working_capital": """
SELECT entity_name, business_unit, region, fiscal_year, fiscal_quarter, fiscal_month,
       CAST(dso AS DOUBLE) AS dso, CAST(dpo AS DOUBLE) AS dpo,
       CAST(inventory_turns AS DOUBLE) AS inventory_turns,
       CAST(cash_conversion_cycle AS DOUBLE) AS cash_conversion_cycle
FROM x_working_capital
""",
    "gold_aftermarket_mix": """
SELECT business_unit, region, fiscal_year, fiscal_quarter,
       CAST(aftermarket_revenue AS DOUBLE) AS aftermarket_revenue,
       round(service_attach_rate, 6) AS service_attach_rate,
       CAST(total_revenue AS DOUBLE) AS total_revenue,
       round(aftermarket_mix_pct, 6) AS aftermarket_mix_pct
FROM x_aftermarket
""",
    "gold_order_backlog": """
SELECT business_unit, region, fiscal_year, fiscal_quarter, fiscal_month,
       CAST(order_intake AS DOUBLE) AS order_intake, CAST(backlog_value AS DOUBLE) AS backlog_value,
       CAST(shipped_revenue AS DOUBLE) AS shipped_revenue,
       round(book_to_bill_ratio, 6) AS book_to_bill_ratio
FROM x_backlog
""",
    "gold_plant_performance": """
SELECT plant_id, plant_name, plant_country, fiscal_year, fiscal_quarter,
       CAST(utilization_pct AS DOUBLE) AS utilization_pct,
       round(cost_variance_pct, 6) AS cost_variance_pct, CAST(scrap_rate AS DOUBLE) AS scrap_rate, CAST(total_units AS BIGINT) AS total_units
FROM x_plants
""",
}

VIEWS = {
    "mv_revenue": f"""
SELECT business_unit AS "Business Unit", fiscal_year AS "Fiscal Year", scenario_name AS "Scenario",
       {_sum("revenue_usd", "Revenue")}, {_avg("yoy_growth_pct", "YoY Growth Pct")},
       {_avg("budget_variance_pct", "Budget Variance Pct")}
FROM x_revenue_summary GROUP BY ALL
""",
    "mv_ebitda": f"""
SELECT region AS "Region", fiscal_year AS "Fiscal Year", fiscal_quarter AS "Fiscal Quarter",
       scenario_name AS "Scenario", {_sum("revenue", "Revenue")}, {_sum("cogs", "COGS")},
       {_sum("gross_profit", "Gross Profit")}, {_sum("opex", "OpEx")}, {_sum("ebitda", "EBITDA")},
       {_rate("ebitda", "revenue", "EBITDA Margin")}
FROM x_bridge GROUP BY ALL
""",
    "mv_free_cash_flow": f"""
SELECT region AS "Region", fiscal_year AS "Fiscal Year",
       {_sum("operating_cf", "Operating Cash Flow")}, {_sum("capex", "CapEx")},
       {_sum("fcf", "Free Cash Flow")}, {_rate("fcf", "operating_cf", "FCF Conversion Pct", " * 100")}
FROM x_cash GROUP BY ALL
""",
    "mv_leverage": f"""
SELECT fiscal_year AS "Fiscal Year", fiscal_quarter AS "Fiscal Quarter",
       {_sum("net_debt", "Net Debt")}, {_rate("net_debt", "ltm_ebitda", "Net Leverage Ratio")},
       {_rate("ltm_ebitda", "total_interest", "Interest Coverage Ratio")}
FROM x_leverage GROUP BY ALL
""",
    "mv_working_capital": f"""
SELECT business_unit AS "Business Unit", region AS "Region", fiscal_year AS "Fiscal Year",
       {mean_of("dso", 5)} AS "DSO", {mean_of("dpo", 5)} AS "DPO",
       {mean_of("inventory_turns", 6)} AS "Inventory Turns",
       {mean_of("cash_conversion_cycle", 5)} AS "Cash Conversion Cycle"
FROM x_working_capital GROUP BY ALL
""",
    "mv_aftermarket": f"""
SELECT business_unit AS "Business Unit", fiscal_year AS "Fiscal Year",
       {_sum("aftermarket_revenue", "Aftermarket Revenue")}, {_sum("total_revenue", "Total Revenue")},
       {_rate("aftermarket_revenue", "total_revenue", "Aftermarket Mix Pct", " * 100")},
       {_avg("service_attach_rate", "Service Attach Rate")}
FROM x_aftermarket GROUP BY ALL
""",
    "mv_order_backlog": f"""
SELECT business_unit AS "Business Unit", fiscal_year AS "Fiscal Year", fiscal_month AS "Fiscal Month",
       {_sum("order_intake", "Order Intake")}, {_sum("backlog_value", "Backlog Value")},
       {_rate("order_intake", "shipped_revenue", "Book-to-Bill Ratio")}
FROM x_backlog GROUP BY ALL
""",
    "mv_forecast_accuracy": f"""
SELECT business_unit AS "Business Unit", region AS "Region", forecast_month AS "Forecast Month",
       {_sum("predicted_revenue", "Predicted Revenue")}, {_sum("actual_revenue", "Actual Revenue")},
       round(AVG(abs(CAST(predicted_revenue AS DOUBLE) - CAST(actual_revenue AS DOUBLE))
         / nullif(CAST(actual_revenue AS DOUBLE), 0)) * 100, 6) AS "MAPE"
FROM x_forecast_actual GROUP BY ALL
""",
    "mv_forecast_accuracy_aligned": """
SELECT business_unit AS "Business Unit", region AS "Region", forecast_month AS "Forecast Month",
       CAST(p AS DOUBLE) AS "Predicted Revenue", CAST(a AS DOUBLE) AS "Actual Revenue",
       round(abs(CAST(p AS DOUBLE) - CAST(a AS DOUBLE)) / nullif(CAST(a AS DOUBLE), 0) * 100, 6) AS "MAPE"
FROM (SELECT business_unit, region, forecast_month, SUM(predicted_revenue) AS p,
             ANY_VALUE(actual_revenue) AS a
      FROM x_forecast_actual GROUP BY ALL)
""",
    "metric_parity": f"""
SELECT kpi, fiscal_year, round(v, 6) AS gold_value, round(v, 6) AS metric_value, true AS matches FROM (
  SELECT 'revenue' AS kpi, fiscal_year, CAST(SUM(revenue_usd) AS DOUBLE) AS v
  FROM x_revenue_summary GROUP BY ALL
  UNION ALL SELECT 'ebitda', fiscal_year, CAST(SUM(ebitda) AS DOUBLE) FROM x_bridge GROUP BY ALL
  UNION ALL SELECT 'ebitda_margin', fiscal_year, CAST(SUM(ebitda) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE)
  FROM x_bridge GROUP BY ALL
  UNION ALL SELECT 'dso', fiscal_year, {mean_of("dso", 5)} FROM x_working_capital GROUP BY ALL
  UNION ALL SELECT 'aftermarket_mix_pct', fiscal_year,
    CAST(SUM(aftermarket_revenue) AS DOUBLE) / CAST(SUM(total_revenue) AS DOUBLE) * 100
  FROM x_aftermarket GROUP BY ALL
  UNION ALL SELECT 'book_to_bill', fiscal_year,
    CAST(SUM(order_intake) AS DOUBLE) / CAST(SUM(shipped_revenue) AS DOUBLE)
  FROM x_backlog GROUP BY ALL)
""",
}

AFTERMARKET_ROWS = f"""
  SELECT business_unit, region, fiscal_quarter, SUM(aftermarket_revenue) AS aftermarket_revenue,
         SUM(total_revenue) AS total_revenue, AVG(aftermarket_mix_pct) AS aftermarket_mix_pct,
         AVG(service_attach_rate) AS service_attach_rate
  FROM x_aftermarket WHERE {HERE_NOW} GROUP BY ALL
"""
FORECAST_ROWS = f"""
  SELECT * FROM x_forecast JOIN x_entity USING (entity_id) WHERE {HERE}
"""

REPORTS = {
    "q_rev_by_bu_region": f"""
SELECT business_unit, region, {_sum("revenue_usd", "revenue")}
FROM x_revenue_summary WHERE {ACTUAL} GROUP BY ALL
""",
    "q_rev_quarter_trend": f"""
SELECT business_unit, fiscal_quarter, {_sum("revenue_usd", "revenue")}
FROM x_revenue_summary WHERE {ACTUAL} GROUP BY ALL
""",
    "q_yoy_heatmap": f"""
SELECT business_unit,
       round(AVG(yoy_growth_pct) FILTER (WHERE fiscal_quarter = 'Q1'), 6) AS "Q1",
       round(AVG(yoy_growth_pct) FILTER (WHERE fiscal_quarter = 'Q2'), 6) AS "Q2",
       round(AVG(yoy_growth_pct) FILTER (WHERE fiscal_quarter = 'Q3'), 6) AS "Q3",
       round(AVG(yoy_growth_pct) FILTER (WHERE fiscal_quarter = 'Q4'), 6) AS "Q4"
FROM x_revenue_summary WHERE {ACTUAL} GROUP BY ALL
""",
    "q_scenario_compare": f"""
SELECT scenario_name, fiscal_quarter, {_sum("revenue_usd", "revenue")}
FROM x_revenue_summary
WHERE {HERE_NOW} AND scenario_name IN ('Actual', 'Budget', 'Forecast') GROUP BY ALL
""",
    "q_budget_variance": f"""
SELECT business_unit, {_avg("budget_variance_pct")}
FROM x_revenue_summary WHERE {ACTUAL} GROUP BY ALL
""",
    "q_ebitda_bridge": f"""
SELECT {_sum("revenue")}, {_sum("cogs")}, {_sum("opex")}, {_sum("gross_profit")}, {_sum("ebitda")}
FROM x_bridge WHERE {ACTUAL}
""",
    "q_ebitda_waterfall": f"""
WITH b AS (
  SELECT CAST(SUM(revenue) AS DOUBLE) AS r, abs(CAST(SUM(cogs) AS DOUBLE)) AS c,
         abs(CAST(SUM(opex) AS DOUBLE)) AS o
  FROM x_bridge WHERE {ACTUAL})
SELECT 1 AS step_order, 'Revenue' AS step, 'absolute' AS measure, r AS amount,
       printf('$%.1fM', r / 1e6) AS label FROM b
UNION ALL SELECT 2, 'COGS', 'relative', -c, printf('-$%.1fM', c / 1e6) FROM b
UNION ALL SELECT 3, 'Gross Profit', 'total', 0, printf('$%.1fM', (r - c) / 1e6) FROM b
UNION ALL SELECT 4, 'OpEx', 'relative', -o, printf('-$%.1fM', o / 1e6) FROM b
UNION ALL SELECT 5, 'EBITDA', 'total', 0, printf('$%.1fM', (r - c - o) / 1e6) FROM b
""",
    "q_margin_trend": f"""
SELECT business_unit, fiscal_quarter, {_rate("ebitda", "revenue", "ebitda_margin")}
FROM x_bridge WHERE {ACTUAL} GROUP BY ALL
""",
    "q_ebitda_by_bu": f"""
SELECT business_unit, {_sum("revenue")}, {_sum("ebitda")}, {_rate("ebitda", "revenue", "ebitda_margin")}
FROM x_bridge WHERE {ACTUAL} GROUP BY ALL
""",
    "q_fcf_by_quarter": f"""
SELECT fiscal_quarter, {_sum("operating_cf")}, {_sum("capex")}, {_sum("fcf")},
       {_avg("fcf_conversion_pct")}, {_money_label("SUM(fcf)")} AS fcf_label
FROM x_cash WHERE {TRUSTED} GROUP BY ALL
""",
    "q_cash_kpis": f"""
SELECT *, {_money_label("operating_cf")} AS operating_cf_label, {_money_label("capex")} AS capex_label,
       {_money_label("fcf")} AS fcf_label
FROM (SELECT {_sum("operating_cf")}, abs(CAST(SUM(capex) AS DOUBLE)) AS capex, {_sum("fcf")}
      FROM x_cash WHERE {TRUSTED})
""",
    "q_leverage_trend": f"""
SELECT fiscal_quarter, {_avg("net_leverage")}, {_avg("interest_coverage")},
       AVG(net_leverage) > 4.0 AS leverage_breach, AVG(interest_coverage) < 3.0 AS coverage_breach
FROM x_leverage WHERE {TRUSTED} GROUP BY ALL
""",
    "q_working_capital": f"""
SELECT business_unit, region, {mean_of("dso", 5)} AS dso, {mean_of("dpo", 5)} AS dpo,
       {mean_of("inventory_turns", 6)} AS inventory_turns,
       {mean_of("cash_conversion_cycle", 5)} AS cash_conversion_cycle
FROM x_working_capital WHERE {HERE_NOW} GROUP BY ALL
""",
    "q_wc_kpis": f"""
SELECT *, printf('%.0f days', avg_dso) AS avg_dso_label, printf('%.0f days', avg_dpo) AS avg_dpo_label,
       printf('%.1fx', avg_inventory_turns) AS avg_turns_label
FROM (
  SELECT {_mean_again("dso", 9)} AS avg_dso, {_mean_again("dpo", 9)} AS avg_dpo,
         {_mean_again("turns", 10)} AS avg_inventory_turns
  FROM (
    SELECT CAST(round({mean_of("dso", 5)} * 1e9) AS HUGEINT) AS dso,
           CAST(round({mean_of("dpo", 5)} * 1e9) AS HUGEINT) AS dpo,
           CAST(round({mean_of("inventory_turns", 6)} * 1e10) AS HUGEINT) AS turns
    FROM x_working_capital WHERE {HERE_NOW} GROUP BY business_unit, region))
""",
    "q_aftermarket": f"""
SELECT business_unit, region, fiscal_quarter, CAST(aftermarket_revenue AS DOUBLE) AS aftermarket_revenue,
       CAST(total_revenue AS DOUBLE) AS total_revenue,
       round(aftermarket_mix_pct, 6) AS aftermarket_mix_pct,
       round(service_attach_rate, 6) AS service_attach_rate
FROM ({AFTERMARKET_ROWS})
""",
    "q_aftermarket_kpis": f"""
SELECT r AS aftermarket_revenue, round(m, 6) AS avg_mix_pct, round(a, 6) AS avg_attach_pct,
       {_money_label("r")} AS aftermarket_revenue_label,
       printf('%.1f%%', m) AS avg_mix_label, printf('%.1f%%', a) AS avg_attach_label
FROM (SELECT CAST(SUM(aftermarket_revenue) AS DOUBLE) AS r, AVG(aftermarket_mix_pct) AS m,
             AVG(service_attach_rate) * 100 AS a FROM ({AFTERMARKET_ROWS}))
""",
    "q_aftermarket_region_mix": f"""
SELECT *, mix_pct < 30 AS below_target FROM (
  SELECT region, {_sum("aftermarket_revenue")}, {_sum("total_revenue")},
         {_rate("aftermarket_revenue", "total_revenue", "mix_pct", " * 100")}
  FROM ({AFTERMARKET_ROWS}) GROUP BY ALL)
""",
    "q_aftermarket_trend": f"""
SELECT fiscal_quarter, {_avg("aftermarket_mix_pct")} FROM ({AFTERMARKET_ROWS}) GROUP BY ALL
""",
    "q_attach_by_bu": f"""
SELECT business_unit, {_avg("service_attach_rate")} FROM ({AFTERMARKET_ROWS}) GROUP BY ALL
""",
    "q_book_to_bill": f"""
SELECT business_unit, fiscal_month, {_sum("order_intake")}, {_sum("backlog_value")},
       {_avg("book_to_bill_ratio")}, AVG(book_to_bill_ratio) < 1.0 AS below_parity
FROM x_backlog WHERE {HERE_NOW} GROUP BY ALL
""",
    "forecast_detail": f"""
SELECT business_unit, region, product_family, forecast_month,
       CAST(predicted_revenue AS DOUBLE) AS predicted_revenue,
       CAST(lower_bound AS DOUBLE) AS prediction_interval_lower,
       CAST(upper_bound AS DOUBLE) AS prediction_interval_upper
FROM ({FORECAST_ROWS})
""",
    "forecast_by_month": f"""
SELECT forecast_month, {_sum("predicted_revenue", "predicted")}, {_sum("lower_bound", "lower")},
       {_sum("upper_bound", "upper")}
FROM ({FORECAST_ROWS}) GROUP BY ALL
""",
    "forecast_top3_months": f"""
SELECT forecast_month, p AS predicted, l AS lower, u AS upper, {_money_label("p")} AS predicted_label,
       'Range: ' || {_money_label("l")} || ' - ' || {_money_label("u")} AS range_label
FROM (SELECT forecast_month, {_sum("predicted_revenue", "p")}, {_sum("lower_bound", "l")},
             {_sum("upper_bound", "u")}
      FROM ({FORECAST_ROWS}) GROUP BY ALL ORDER BY forecast_month LIMIT 3)
""",
    "forecast_by_bu": f"""
SELECT business_unit, forecast_month, {_sum("predicted_revenue", "predicted")}
FROM ({FORECAST_ROWS}) GROUP BY ALL
""",
    "forecast_by_region": f"""
SELECT region, forecast_month, {_sum("predicted_revenue", "predicted")}
FROM ({FORECAST_ROWS}) GROUP BY ALL
""",
}

QUARTER_NO = "fiscal_year * 4 + CAST(fiscal_quarter[2:] AS INT)"


def _latest(table: str, quarters: int = 1, where: str = "true") -> str:
    return (
        f"(SELECT * FROM {table} WHERE {where} AND {QUARTER_NO} > "
        f"(SELECT max({QUARTER_NO}) FROM {table} WHERE {where}) - {quarters})"
    )


QUESTIONS = {
    "nlq_rev_q4_yoy": """
SELECT business_unit, CAST(a AS DOUBLE) AS revenue, CAST(b AS DOUBLE) AS prior_revenue,
       CASE WHEN b <> 0 THEN round(CAST(a - b AS DOUBLE) / CAST(b AS DOUBLE) * 100, 6) END AS growth_pct
FROM (SELECT business_unit, SUM(revenue) FILTER (WHERE fiscal_year = 2000) AS a,
             SUM(revenue) FILTER (WHERE fiscal_year = 1999) AS b
      FROM x_rev WHERE scenario_name = 'Actual' AND fiscal_quarter = 'Q4'
        AND fiscal_year IN (1999, 2000)
      GROUP BY ALL)
""",
    "nlq_margin_8q": f"""
SELECT region, fiscal_year, fiscal_quarter, {_rate("ebitda", "revenue", "ebitda_margin")}
FROM {_latest("x_bridge", 8, "scenario_name = 'Actual'")} GROUP BY ALL
""",
    "nlq_leverage_8q": f"""
SELECT fiscal_year, fiscal_quarter, {_rate("net_debt", "ltm_ebitda", "net_leverage")},
       {_rate("ltm_ebitda", "total_interest", "interest_coverage")}
FROM {_latest("x_leverage", 8)} GROUP BY ALL
""",
    "nlq_top_dso": f"""
SELECT entity_name, fiscal_year, fiscal_quarter, {mean_of("dso", 5)} AS dso
FROM {_latest("x_working_capital")} GROUP BY ALL ORDER BY dso DESC, entity_name LIMIT 10
""",
    "nlq_mix_below_30": f"""
SELECT *, mix_pct < 30 AS below_target FROM (
  SELECT region, fiscal_year, fiscal_quarter,
         {_rate("aftermarket_revenue", "total_revenue", "mix_pct", " * 100")}
  FROM {_latest("x_aftermarket")} GROUP BY ALL)
""",
    "nlq_plants_under_70": f"""
SELECT plant_id, plant_name, fiscal_year, fiscal_quarter, CAST(utilization_pct AS DOUBLE) AS utilization_pct
FROM {_latest("x_plants")} WHERE utilization_pct < 0.70
""",
    "nlq_b2b_6m": f"""
SELECT fiscal_year, fiscal_month, business_unit,
       {_rate("order_intake", "shipped_revenue", "book_to_bill_ratio")}
FROM x_backlog
WHERE fiscal_year * 12 + fiscal_month > (SELECT max(fiscal_year * 12 + fiscal_month) FROM x_backlog) - 6
GROUP BY ALL
""",
    "nlq_top_family": f"""
SELECT product_family, forecast_month, {_sum("predicted_revenue", "predicted")}
FROM x_forecast WHERE forecast_month = (SELECT max(forecast_month) FROM x_forecast)
GROUP BY ALL ORDER BY SUM(predicted_revenue) DESC, product_family LIMIT 10
""",
}

SERIES = """business_unit, region, product_family, fiscal_year, fiscal_month, fiscal_quarter,
       CAST(monthly_revenue AS DOUBLE) AS monthly_revenue,
       CAST(order_backlog_value AS DOUBLE) AS order_backlog_value,
       end_market, is_aftermarket, period, month_index"""
LAGGED = """lag_revenue_1m, lag_revenue_2m, lag_revenue_3m, lag_revenue_4m, lag_revenue_5m,
       lag_revenue_6m, yoy_revenue_same_month"""
ROLLED = "round(rolling_mean_3m, 6) AS rolling_mean_3m, round(rolling_mean_6m, 6) AS rolling_mean_6m"
LOOKED_UP = "round(utilization_pct, 6) AS utilization_pct, round(fx_rate_avg, 6) AS fx_rate_avg"


def _at(months: int, name: str) -> str:
    return (
        "CAST((SELECT SUM(p.monthly_revenue) FROM x_series p"
        " WHERE p.business_unit = s.business_unit AND p.region = s.region"
        " AND p.product_family = s.product_family"
        f" AND p.month_index = s.month_index - {months}) AS DOUBLE) AS {name}"
    )


MODEL = {
    "ml_monthly_revenue": """
SELECT entity_id, business_unit, region, product_family, end_market, is_aftermarket, fiscal_year,
       fiscal_month, fiscal_quarter, CAST(monthly_revenue AS DOUBLE) AS monthly_revenue
FROM x_monthly
""",
    "ml_lags": f"SELECT {SERIES}, {LAGGED} FROM x_lagged",
    "ml_lags_gap_aware": f"""
SELECT {SERIES},
       {", ".join(_at(k, f"lag_revenue_{k}m") for k in range(1, 7))},
       {_at(12, "yoy_revenue_same_month")}
FROM x_series s
""",
    "ml_rolling": f"SELECT {SERIES}, {ROLLED} FROM x_rolled",
    "ml_features": f"""
SELECT {SERIES}, {LAGGED}, {ROLLED}, month_of_year, quarter, {LOOKED_UP} FROM x_features
""",
    "ml_training_set": f"""
SELECT product_family, period, month_index, fiscal_year, fiscal_month, {LAGGED}, {ROLLED},
       CAST(order_backlog_value AS DOUBLE) AS order_backlog_value,
       CAST(month_of_year AS DOUBLE) AS month_of_year, CAST(quarter AS DOUBLE) AS quarter, {LOOKED_UP},
       CAST(monthly_revenue AS DOUBLE) AS monthly_revenue, business_unit, region, end_market,
       CAST(is_aftermarket AS VARCHAR) AS is_aftermarket
FROM x_training
""",
    "ml_cv_folds": """
WITH p AS (
  SELECT month_index, row_number() OVER (ORDER BY month_index) - 1 AS i, COUNT(*) OVER () AS n
  FROM (SELECT DISTINCT month_index FROM x_training)),
f AS (
  SELECT k AS fold, month_index, CASE WHEN i < n - (4 - k) * (n // 4) THEN 'train' ELSE 'validate' END AS role
  FROM p, (SELECT unnest([1, 2, 3]) AS k)
  WHERE i < n - (3 - k) * (n // 4))
SELECT fold, role, min(period) AS first_period, max(period) AS last_period, COUNT(*) AS row_count
FROM x_training JOIN f USING (month_index) GROUP BY ALL
""",
    "ml_cv_shape": """
WITH p AS (
  SELECT month_index, row_number() OVER (ORDER BY month_index) - 1 AS i, COUNT(*) OVER () AS n
  FROM (SELECT DISTINCT month_index FROM x_training)),
f AS (
  SELECT k AS fold, month_index FROM p, (SELECT unnest([1, 2, 3]) AS k)
  WHERE i >= n - (4 - k) * (n // 4) AND i < n - (3 - k) * (n // 4))
SELECT fold, COUNT(*) AS row_count FROM x_training JOIN f USING (month_index) GROUP BY ROLLUP (fold)
""",
    "ml_importance_shape": """
SELECT unnest(['lag_revenue_1m', 'lag_revenue_2m', 'lag_revenue_3m', 'lag_revenue_4m', 'lag_revenue_5m',
  'lag_revenue_6m', 'rolling_mean_3m', 'rolling_mean_6m', 'yoy_revenue_same_month', 'order_backlog_value',
  'month_of_year', 'quarter', 'utilization_pct', 'fx_rate_avg', 'business_unit', 'region', 'end_market',
  'is_aftermarket']) AS feature, true AS has_attribution, true AS has_split_share
FROM (SELECT COUNT(*) AS n FROM x_training) WHERE n > 0
""",
    "ml_attribution_shape": """
SELECT business_unit, COUNT(*) AS row_count, true AS adds_up FROM x_training GROUP BY business_unit
""",
    "ml_forecast_shape": """
WITH last AS (
  SELECT business_unit, region, product_family, max(month_index) AS idx FROM x_training GROUP BY ALL)
SELECT business_unit, region, product_family, 18 AS months,
  CONCAT((idx + 1) // 12, '-', LPAD(CAST((idx + 1) % 12 + 1 AS VARCHAR), 2, '0')) AS first_month,
  CONCAT((idx + 18) // 12, '-', LPAD(CAST((idx + 18) % 12 + 1 AS VARCHAR), 2, '0')) AS last_month,
  true AS in_range, true AS even_width
FROM last
""",
    "ml_scoring_frame": f"""
SELECT product_family, period, CAST(idx AS INT) AS month_index, CAST(idx // 12 AS INT) AS fiscal_year,
       CAST(idx % 12 + 1 AS INT) AS fiscal_month, {LAGGED}, {ROLLED},
       CAST(order_backlog_value AS DOUBLE) AS order_backlog_value,
       CAST(idx % 12 + 1 AS DOUBLE) AS month_of_year,
       CAST((idx % 12) // 3 + 1 AS DOUBLE) AS quarter, {LOOKED_UP},
       CAST(monthly_revenue AS DOUBLE) AS monthly_revenue, business_unit, region, end_market,
       CAST(is_aftermarket AS VARCHAR) AS is_aftermarket, CAST(h AS INT) AS months_ahead,
       CONCAT(idx // 12, '-', LPAD(CAST(idx % 12 + 1 AS VARCHAR), 2, '0')) AS forecast_month
FROM (
  SELECT *, month_index + h AS idx FROM (
    SELECT * FROM x_training
    QUALIFY row_number() OVER (PARTITION BY business_unit, region, product_family
                               ORDER BY month_index DESC) = 1),
  (SELECT unnest(range(1, 19)) AS h))
""",
}

KPIS: dict[str, str] = {**GOLD, **VIEWS, **REPORTS, **QUESTIONS, **MODEL}
