"""Shared ``WITH`` parts: planning tables over the raw tables."""


def mean_units(total: str, count: str) -> str:
    """Whole units nearest to total / count, halves away from zero."""
    return f"(sign({total}) * ((2 * abs({total}) + {count}) // (2 * {count})))"


def mean_of(column: str, scale: int) -> str:
    """Mean of a decimal column with four more places than it has, as a double."""
    total = f"SUM(CAST({column} * {10**scale} AS BIGINT))::HUGEINT * 10000"
    return f"CAST({mean_units(f'({total})', f'COUNT({column})')} AS DOUBLE) / {10 ** (scale + 4)}"


def _mean_decimal(total: str, scale: int) -> str:
    units = mean_units(f"({total})", "COUNT(*)")
    return f"CAST(CAST({units} AS DOUBLE) / {10**scale} AS DECIMAL(18,{scale}))"


PARTS: dict[str, str] = {
    "x_line": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
           l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
""",
    "x_entity": """
SELECT c_custkey AS entity_id, c_name AS entity_name, c_mktsegment AS business_unit,
       r_name AS region, n_name AS country, c_acctbal < 0 AS is_consolidated
FROM customer, nation, region
WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
""",
    "x_plant": """
SELECT s_suppkey, s_name, s_nationkey, n_name, r_name
FROM supplier, nation, region
WHERE s_nationkey = n_nationkey AND n_regionkey = r_regionkey
""",
    "x_gl": """
SELECT l_orderkey, l_linenumber, o_custkey AS entity_id,
       CAST(l_shipdate AS DATE) AS d,
       CAST(year(l_shipdate) AS INT) AS fy, 'Q' || quarter(l_shipdate) AS fq, CAST(month(l_shipdate) AS INT) AS fm,
       CASE WHEN l_linestatus = 'F' THEN 'CF' WHEN l_returnflag = 'R' THEN 'Revenue'
         WHEN l_returnflag = 'A' THEN 'COGS' WHEN l_returnflag = 'N' THEN 'OpEx' ELSE 'Unassigned' END AS kind,
       CASE l_returnflag || l_linestatus
         WHEN 'RF' THEN 'CF_OPS' WHEN 'AF' THEN 'CF_INV' WHEN 'NF' THEN 'CF_FIN' END AS flow,
       CASE o_orderpriority
         WHEN '1-URGENT' THEN 'Actual' WHEN '2-HIGH' THEN 'Budget' WHEN '3-MEDIUM' THEN 'Forecast'
         WHEN '4-NOT SPECIFIED' THEN 'Upside' WHEN '5-LOW' THEN 'Downside' ELSE 'Unassigned' END AS scenario_name,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_usd
FROM x_line JOIN orders ON l_orderkey = o_orderkey
""",
    "x_orders": """
SELECT l_orderkey, l_linenumber, o_custkey AS entity_id, l_partkey AS product_id,
       CAST(year(o_orderdate) AS INT) AS fy, 'Q' || quarter(o_orderdate) AS fq, CAST(month(o_orderdate) AS INT) AS fm,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS DECIMAL(18,2)) AS net,
       CAST(l_quantity AS INT) AS qty,
       CAST(l_discount AS DECIMAL(8,4)) AS disc,
       (CAST(round(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT))
         // (2 * CAST(l_quantity AS BIGINT)) AS unit_cents,
       o_orderstatus, l_linestatus
FROM x_line JOIN orders ON l_orderkey = o_orderkey
""",
    "x_rev": """
SELECT business_unit, region, fy AS fiscal_year, fq AS fiscal_quarter, fm AS fiscal_month,
       scenario_name, SUM(amount_usd) AS revenue
FROM x_gl JOIN x_entity USING (entity_id)
WHERE kind = 'Revenue'
GROUP BY ALL
""",
    "x_revenue_summary": """
SELECT a.business_unit, a.region, a.fiscal_year, a.fiscal_quarter, a.fiscal_month,
       a.scenario_name, a.revenue AS revenue_usd,
       p.revenue AS py_revenue, b.revenue AS budget_revenue,
       CASE WHEN p.revenue <> 0 THEN
         CAST(a.revenue - p.revenue AS DOUBLE) / CAST(p.revenue AS DOUBLE) * 100 END AS yoy_growth_pct,
       CASE WHEN b.revenue <> 0 THEN
         CAST(a.revenue - b.revenue AS DOUBLE) / CAST(b.revenue AS DOUBLE) * 100 END
         AS budget_variance_pct
FROM x_rev a
LEFT JOIN x_rev p ON a.business_unit = p.business_unit AND a.region = p.region
  AND a.fiscal_month = p.fiscal_month AND a.scenario_name = p.scenario_name
  AND a.fiscal_year = p.fiscal_year + 1
LEFT JOIN x_rev b ON a.business_unit = b.business_unit AND a.region = b.region
  AND a.fiscal_month = b.fiscal_month AND a.fiscal_year = b.fiscal_year
  AND b.scenario_name = 'Budget'
""",
    "x_bridge_base": """
SELECT business_unit, region, fy AS fiscal_year, fq AS fiscal_quarter, scenario_name,
       SUM(amount_usd) FILTER (WHERE kind = 'Revenue') AS revenue,
       SUM(amount_usd) FILTER (WHERE kind = 'COGS') AS cogs,
       SUM(amount_usd) FILTER (WHERE kind = 'OpEx') AS opex
FROM x_gl JOIN x_entity USING (entity_id)
GROUP BY ALL
""",
    "x_bridge": """
SELECT *, revenue - coalesce(cogs, 0) AS gross_profit,
       revenue - coalesce(cogs, 0) - coalesce(opex, 0) AS ebitda
FROM x_bridge_base
""",
    "x_cash_rows": """
SELECT entity_name, region, fy AS fiscal_year, fq AS fiscal_quarter, scenario_name, flow, amount_usd
FROM x_gl JOIN x_entity USING (entity_id)
WHERE kind = 'CF'
""",
    "x_cash": """
SELECT *, coalesce(operating_cf, 0) + coalesce(capex, 0) AS fcf,
       CASE WHEN operating_cf <> 0 THEN
         CAST(coalesce(operating_cf, 0) + coalesce(capex, 0) AS DOUBLE)
           / CAST(operating_cf AS DOUBLE) * 100 END AS fcf_conversion_pct
FROM (
  SELECT entity_name, region, fiscal_year, fiscal_quarter,
         SUM(amount_usd) FILTER (WHERE flow = 'CF_OPS') AS operating_cf,
         SUM(amount_usd) FILTER (WHERE flow = 'CF_INV') AS capex,
         SUM(amount_usd) FILTER (WHERE flow = 'CF_FIN') AS financing_cf
  FROM x_cash_rows GROUP BY ALL)
""",
    "x_debt": """
SELECT o_custkey AS entity_id, CAST(year(o_orderdate) AS INT) AS fiscal_year,
       'Q' || quarter(o_orderdate) AS fiscal_quarter, CAST(month(o_orderdate) AS INT) AS fiscal_month,
       CAST(o_totalprice AS DECIMAL(18,2)) AS principal,
       CAST(((CAST(round(o_totalprice * 100) AS BIGINT) * 55 * 2 + 12000) // 24000) / 100.0
            AS DECIMAL(18,2)) AS interest
FROM orders
""",
    "x_leverage": """
SELECT entity_id, fiscal_year, fiscal_quarter, SUM(principal) AS net_debt,
       SUM(interest) AS total_interest, CAST(350000000 AS DOUBLE) AS ltm_ebitda,
       CAST(SUM(principal) AS DOUBLE) / 350000000 AS net_leverage,
       CASE WHEN SUM(interest) > 0 THEN 350000000 / CAST(SUM(interest) AS DOUBLE) END
         AS interest_coverage
FROM x_debt GROUP BY entity_id, fiscal_year, fiscal_quarter
""",
    "x_wc": """
SELECT o_custkey AS entity_id, CAST(l_shipdate AS DATE) AS d,
       30 + abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 60 AS dso,
       CAST(l_quantity AS BIGINT) AS dpo,
       (2 * CAST(round(l_extendedprice * 100) AS BIGINT) * 10 + CAST(round(p_retailprice * 100) AS BIGINT))
         // (2 * CAST(round(p_retailprice * 100) AS BIGINT)) AS turns_hundredths
FROM x_line JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
""",
    "x_working_capital": f"""
SELECT *, dso - dpo + 30 AS cash_conversion_cycle FROM (
  SELECT entity_name, business_unit, region, CAST(year(d) AS INT) AS fiscal_year,
         'Q' || quarter(d) AS fiscal_quarter, CAST(month(d) AS INT) AS fiscal_month,
         {_mean_decimal("SUM(dso) * 100000", 5)} AS dso,
         {_mean_decimal("SUM(dpo) * 100000", 5)} AS dpo,
         {_mean_decimal("SUM(turns_hundredths) * 10000", 6)} AS inventory_turns
  FROM x_wc JOIN x_entity USING (entity_id)
  GROUP BY ALL)
""",
    "x_aftermarket": """
SELECT s.*, t.total_revenue,
       CASE WHEN t.total_revenue > 0 THEN
         CAST(s.aftermarket_revenue AS DOUBLE) / CAST(t.total_revenue AS DOUBLE) * 100 END
         AS aftermarket_mix_pct
FROM (
  SELECT business_unit, region, fy AS fiscal_year, fq AS fiscal_quarter,
         SUM(net) AS aftermarket_revenue,
         CAST(COUNT(*) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) / COUNT(*) AS service_attach_rate
  FROM x_orders JOIN x_entity USING (entity_id)
  WHERE product_id IN (SELECT p_partkey FROM part WHERE p_type IN ('PROMO', 'SMALL'))
  GROUP BY ALL) s
LEFT JOIN (
  SELECT business_unit, region, fy AS fiscal_year, fq AS fiscal_quarter, SUM(net) AS total_revenue
  FROM x_orders JOIN x_entity USING (entity_id)
  GROUP BY ALL) t USING (business_unit, region, fiscal_year, fiscal_quarter)
""",
    "x_backlog": """
SELECT *, CASE WHEN shipped_revenue > 0 THEN
    CAST(order_intake AS DOUBLE) / CAST(shipped_revenue AS DOUBLE) END AS book_to_bill_ratio
FROM (
  SELECT business_unit, region, fy AS fiscal_year, fq AS fiscal_quarter, fm AS fiscal_month,
         SUM(net) AS order_intake,
         SUM(CASE WHEN o_orderstatus = 'O' THEN net ELSE 0 END) AS backlog_value,
         SUM(CASE WHEN o_orderstatus = 'F' THEN net ELSE 0 END) AS shipped_revenue
  FROM x_orders JOIN x_entity USING (entity_id)
  GROUP BY ALL)
""",
    "x_plants": f"""
SELECT s_nationkey AS plant_id, n_name AS plant_name, r_name AS plant_country,
       CAST(year(l_shipdate) AS INT) AS fiscal_year, 'Q' || quarter(l_shipdate) AS fiscal_quarter,
       {_mean_decimal("SUM(CAST((1 - 7.5 * CAST(l_tax AS DECIMAL(4,2))) * 10000 AS BIGINT)) * 10000", 8)}
         AS utilization_pct,
       AVG(CASE WHEN standard <> 0 THEN
         CAST(actual - standard AS DOUBLE) / CAST(standard AS DOUBLE) * 100 END) AS cost_variance_pct,
       {_mean_decimal("SUM(CAST(CAST(l_discount AS DECIMAL(8,4)) * 10000 AS BIGINT)) * 10000", 8)}
         AS scrap_rate,
       SUM(CAST(l_quantity AS BIGINT)) AS total_units
FROM (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS actual,
         CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS INT) AS standard
  FROM x_line JOIN part ON l_partkey = p_partkey JOIN x_plant ON l_suppkey = s_suppkey)
GROUP BY ALL
""",
    "x_forecast": """
SELECT *, CAST(predicted_revenue * 0.9 AS DECIMAL(18,2)) AS lower_bound,
       CAST(predicted_revenue * 1.1 AS DECIMAL(18,2)) AS upper_bound
FROM (
  SELECT entity_id, p_brand AS product_family, strftime(d, '%Y-%m') AS forecast_month,
         CAST(SUM(amount_usd) AS DECIMAL(18,2)) AS predicted_revenue
  FROM x_gl JOIN x_line USING (l_orderkey, l_linenumber) JOIN part ON l_partkey = p_partkey
  WHERE scenario_name = 'Forecast'
  GROUP BY ALL)
""",
    "x_forecast_actual": """
SELECT e.business_unit, e.region, f.entity_id, f.forecast_month, f.predicted_revenue,
       r.revenue_usd AS actual_revenue
FROM x_forecast f
JOIN x_entity e ON f.entity_id = e.entity_id
LEFT JOIN x_revenue_summary r
  ON e.business_unit = r.business_unit AND e.region = r.region
 AND f.forecast_month = CONCAT(r.fiscal_year, '-', LPAD(CAST(r.fiscal_month AS VARCHAR), 2, '0'))
 AND r.scenario_name = 'Actual'
""",
    "x_monthly": """
SELECT entity_id, business_unit, region, p_brand AS product_family,
       'EM' || (p_size % 6) AS end_market, p_type IN ('PROMO', 'SMALL') AS is_aftermarket,
       fy AS fiscal_year, fm AS fiscal_month, fq AS fiscal_quarter,
       SUM(net) AS monthly_revenue,
       SUM(CASE WHEN o_orderstatus = 'O' THEN net ELSE 0 END) AS order_backlog_value
FROM x_orders JOIN x_entity USING (entity_id) JOIN part ON product_id = p_partkey
WHERE NOT is_consolidated
GROUP BY ALL
""",
    "x_lead": """
SELECT * FROM (
  SELECT business_unit, region, product_family, fiscal_year, fiscal_month, end_market, is_aftermarket,
         SUM(monthly_revenue) AS part_revenue
  FROM x_monthly GROUP BY ALL)
QUALIFY row_number() OVER (
  PARTITION BY business_unit, region, product_family, fiscal_year, fiscal_month
  ORDER BY part_revenue DESC, end_market DESC, is_aftermarket DESC) = 1
""",
    "x_series": """
SELECT s.*, l.end_market, l.is_aftermarket,
       CONCAT(fiscal_year, '-', LPAD(CAST(fiscal_month AS VARCHAR), 2, '0')) AS period,
       CAST(fiscal_year * 12 + fiscal_month - 1 AS INT) AS month_index
FROM (
  SELECT business_unit, region, product_family, fiscal_year, fiscal_month, fiscal_quarter,
         SUM(monthly_revenue) AS monthly_revenue, SUM(order_backlog_value) AS order_backlog_value
  FROM x_monthly GROUP BY ALL) s
JOIN x_lead l USING (business_unit, region, product_family, fiscal_year, fiscal_month)
""",
    "x_lagged": """
SELECT *,
       CAST(lag(monthly_revenue, 1) OVER w AS DOUBLE) AS lag_revenue_1m,
       CAST(lag(monthly_revenue, 2) OVER w AS DOUBLE) AS lag_revenue_2m,
       CAST(lag(monthly_revenue, 3) OVER w AS DOUBLE) AS lag_revenue_3m,
       CAST(lag(monthly_revenue, 4) OVER w AS DOUBLE) AS lag_revenue_4m,
       CAST(lag(monthly_revenue, 5) OVER w AS DOUBLE) AS lag_revenue_5m,
       CAST(lag(monthly_revenue, 6) OVER w AS DOUBLE) AS lag_revenue_6m,
       CAST(lag(monthly_revenue, 12) OVER w AS DOUBLE) AS yoy_revenue_same_month
FROM x_series
WINDOW w AS (PARTITION BY business_unit, region, product_family ORDER BY month_index)
""",
    "x_rolled": """
SELECT *,
  CAST(SUM(monthly_revenue) OVER w3 AS DOUBLE) / nullif(COUNT(*) OVER w3, 0) AS rolling_mean_3m,
  CAST(SUM(monthly_revenue) OVER w6 AS DOUBLE) / nullif(COUNT(*) OVER w6, 0) AS rolling_mean_6m
FROM x_lagged
WINDOW w3 AS (PARTITION BY business_unit, region, product_family ORDER BY month_index
              ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
       w6 AS (PARTITION BY business_unit, region, product_family ORDER BY month_index
              ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
""",
    "x_features": f"""
SELECT r.*, r.fiscal_month AS month_of_year, CAST(r.fiscal_quarter[2:] AS INT) AS quarter,
       u.utilization_pct, x.fx_rate_avg
FROM x_rolled r
LEFT JOIN (SELECT fiscal_year, fiscal_quarter, {mean_of("utilization_pct", 8)} AS utilization_pct
           FROM x_plants GROUP BY ALL) u USING (fiscal_year, fiscal_quarter)
LEFT JOIN (SELECT CAST(year(l_shipdate) AS INT) AS fiscal_year, CAST(month(l_shipdate) AS INT) AS fiscal_month,
                  CAST(SUM(CAST(1 + CAST(l_tax AS DECIMAL(12,6)) / 2 AS DECIMAL(12,6))) AS DOUBLE)
                    / COUNT(*) AS fx_rate_avg
           FROM x_line GROUP BY ALL) x USING (fiscal_year, fiscal_month)
""",
    "x_training": """
SELECT * FROM x_features
WHERE lag_revenue_1m IS NOT NULL AND lag_revenue_2m IS NOT NULL AND lag_revenue_3m IS NOT NULL
  AND lag_revenue_4m IS NOT NULL AND lag_revenue_5m IS NOT NULL AND lag_revenue_6m IS NOT NULL
  AND rolling_mean_3m IS NOT NULL AND rolling_mean_6m IS NOT NULL
  AND yoy_revenue_same_month IS NOT NULL AND utilization_pct IS NOT NULL
  AND fx_rate_avg IS NOT NULL AND monthly_revenue IS NOT NULL
""",
}
