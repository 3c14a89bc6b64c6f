import pytest
from pyspark.sql import functions as F
from star import dims, journal, money

from tallyforge.plans import gold


def keyed(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def star(make, rows):
    return (journal(make, rows), *dims(make))


REVENUE = [
    ("E1", "A1", "S1", 20240101, 100),
    ("E1", "A1", "S1", 20240101, 50),
    ("E1", "A1", "S1", 20250101, 180),
    ("E1", "A1", "S2", 20250101, 200),
    ("E1", "A1", "S1", 20260101, 0),
    ("E2", "A1", "S1", 20240101, 0),
    ("E2", "A1", "S1", 20250101, 10),
    ("E1", "A2", "S1", 20240101, 999),
    ("E9", "A1", "S1", 20240101, 777),
]


def test_growth_and_variance(make):
    out = keyed(gold.gold_revenue_summary(*star(make, REVENUE)), "business_unit", "fiscal_year", "scenario_name")
    assert out["North", 2024, "Actual"].revenue_usd == money(150)
    assert out["North", 2024, "Actual"].yoy_growth_pct is None
    assert out["North", 2024, "Actual"].budget_variance_pct is None
    assert out["North", 2025, "Actual"].yoy_growth_pct == pytest.approx(20)
    assert out["North", 2025, "Actual"].budget_variance_pct == pytest.approx(-10)
    assert out["North", 2025, "Budget"].budget_variance_pct == 0
    assert out["North", 2026, "Actual"].yoy_growth_pct == pytest.approx(-100)
    # A prior year of zero gives no growth figure.
    assert out["South", 2025, "Actual"].yoy_growth_pct is None
    # The orphan entity joins nothing.
    assert ("South", 2024, "Actual") in out and len(out) == 6


def test_missing_year_is_not_bridged(make):
    rows = [("E1", "A1", "S1", 20240101, 5), ("E1", "A1", "S1", 20260101, 9)]
    out = keyed(gold.yoy_growth(*star(make, rows)), "fiscal_year")
    assert out[(2026,)].py_revenue is None


def test_window_form_equals_join_form(spark, make):
    rows = [
        (e, "A1", s, t, (i * 37) % 11 - 3)
        for i, (e, s, t) in enumerate(
            (e, s, t)
            for e in ("E1", "E2", "E3")
            for s in ("S1", "S2", "S3")
            for t in (20240101, 20240201, 20240401, 20250101, 20250201, 20260101)
        )
    ]
    revenue = gold.monthly_revenue(*star(make, rows))
    a, p = revenue.alias("a"), revenue.alias("p")
    keys = ["business_unit", "region", "fiscal_month", "scenario_name"]
    on = [F.col(f"a.{k}") == F.col(f"p.{k}") for k in keys]
    on.append(F.col("a.fiscal_year") == F.col("p.fiscal_year") + 1)
    joined = a.join(p, on, "left").select("a.*", F.col("p.revenue_usd").alias("py_revenue"))
    windowed = gold.yoy_growth(*star(make, rows)).select(joined.columns)
    assert sorted(map(str, joined.collect())) == sorted(
        map(str, windowed.withColumn("py_revenue", F.col("py_revenue").cast("decimal(28,2)")).collect())
    )


def test_bridge_keeps_groups_without_income_lines(make):
    rows = [
        ("E1", "A1", "S1", 20240101, 100),
        ("E1", "A2", "S1", 20240101, 60),
        ("E1", "A3", "S1", 20240201, 15),
        ("E2", "A4", "S1", 20240101, 7),
        ("E2", "A2", "S1", 20250101, 7),
        ("E2", "A1", "S2", 20250101, 0),
    ]
    out = keyed(gold.gold_ebitda_bridge(*star(make, rows)), "business_unit", "fiscal_year", "scenario_name")
    north = out["North", 2024, "Actual"]
    assert (north.gross_profit, north.ebitda) == (money(40), money(25))
    assert north.ebitda_margin == pytest.approx(0.25)
    only_balance = out["South", 2024, "Actual"]
    assert only_balance.revenue is None and only_balance.ebitda is None and only_balance.cogs is None
    no_revenue = out["South", 2025, "Actual"]
    assert no_revenue.cogs == money(7) and no_revenue.gross_profit is None
    assert out["South", 2025, "Budget"].ebitda == money(0)
    assert out["South", 2025, "Budget"].ebitda_margin is None


CASH = [
    ("E1", "A5", "S1", 20240101, 100),
    ("E1", "A5", "S2", 20240101, 20),
    ("E1", "A6", "S1", 20240201, -30),
    ("E2", "A6", "S1", 20240101, 5),
    ("E2", "A5", "S1", 20250101, 0),
]


def test_cash_flow_sums_scenarios_unless_told(make):
    out = keyed(gold.gold_cash_flow_summary(*star(make, CASH)), "entity_name", "fiscal_year")
    alpha = out["Alpha", 2024]
    assert (alpha.operating_cf, alpha.capex, alpha.fcf) == (money(120), money(-30), money(90))
    assert alpha.fcf_conversion_pct == pytest.approx(75) and alpha.financing_cf is None
    assert out["Beta", 2024].fcf == money(5) and out["Beta", 2024].fcf_conversion_pct is None
    assert out["Beta", 2025].fcf_conversion_pct is None
    actual = keyed(
        gold.gold_cash_flow_summary(*star(make, CASH), scenario_name="Actual"), "entity_name", "fiscal_year"
    )
    assert actual["Alpha", 2024].operating_cf == money(100)
    split = keyed(
        gold.gold_cash_flow_summary(*star(make, CASH), by_scenario=True), "entity_name", "fiscal_year", "scenario_name"
    )
    assert split["Alpha", 2024, "Budget"].operating_cf == money(20)


def debt(make):
    rows = [
        ("E1", 20240101, money(100), money(1)),
        ("E1", 20240201, money(80), money(1)),
        ("E1", 20240401, money(70), money(0)),
        ("E2", 20240101, money(10), money(-2)),
    ]
    return make(
        rows,
        "entity_id string, time_id int, principal_balance decimal(18,2), interest_expense decimal(18,2)",
    )


def test_leverage(make):
    time = dims(make)[2]
    out = keyed(gold.gold_leverage_metrics(debt(make), time, ltm_ebitda=360), "entity_id", "fiscal_quarter")
    assert out["E1", "Q1"].net_debt == money(180) and out["E1", "Q1"].net_leverage == pytest.approx(0.5)
    assert out["E1", "Q1"].interest_coverage == pytest.approx(180)
    # Zero and negative interest both give no coverage.
    assert out["E1", "Q2"].interest_coverage is None and out["E2", "Q1"].interest_coverage is None
    assert gold.gold_leverage_metrics(debt(make), time).first().ltm_ebitda == money(350_000_000)
    end = keyed(
        gold.gold_leverage_metrics(debt(make), time, 360, balance="period_end"), "entity_id", "fiscal_quarter"
    )
    assert end["E1", "Q1"].net_debt == money(80) and end["E1", "Q1"].total_interest == money(2)
    with pytest.raises(ValueError):
        gold.gold_leverage_metrics(debt(make), time, balance="median")


def test_trailing_year(make):
    bridge = make(
        [(2023, f"Q{q}", "Actual", money(10 * q)) for q in (1, 2, 3, 4)]
        + [(2024, "Q1", "Actual", money(1)), (2024, "Q1", "Budget", money(500))],
        "fiscal_year int, fiscal_quarter string, scenario_name string, ebitda decimal(18,2)",
    )
    out = {r.q: r.ltm_ebitda for r in gold.trailing_year_ebitda(bridge).collect()}
    assert out[2023 * 4] == money(10) and out[2023 * 4 + 3] == money(100)
    assert out[2024 * 4] == money(91)
    time = dims(make)[2]
    rows = gold.gold_leverage_metrics(debt(make), time, bridge=bridge)
    assert keyed(rows, "entity_id", "fiscal_quarter")["E1", "Q1"].ltm_ebitda == money(91)


def test_working_capital(make):
    _, entity, time, _ = dims(make)
    wc = make(
        [("E1", 20240101, 50.0, 40.0, 4.0), ("E1", 20240101, 51.0, None, 5.0), ("E1", 20240201, None, None, None)],
        "entity_id string, time_id int, dso double, dpo double, inventory_turns double",
    ).select(
        "entity_id", "time_id", F.col("dso").cast("decimal(8,1)").alias("dso"),
        F.col("dpo").cast("decimal(8,1)").alias("dpo"),
        F.col("inventory_turns").cast("decimal(8,2)").alias("inventory_turns"),
    )
    out = keyed(gold.gold_working_capital(wc, entity, time), "fiscal_month")
    assert (out[(1,)].dso, out[(1,)].dpo, out[(1,)].cash_conversion_cycle) == (50.5, 40.0, 40.5)
    assert out[(2,)].dso is None and out[(2,)].cash_conversion_cycle is None
    shifted = gold.gold_working_capital(wc, entity, time, offset_days=0)
    assert keyed(shifted, "fiscal_month")[(1,)].cash_conversion_cycle == 10.5


def orders(make):
    return make(
        [
            ("E1", 20240101, money(100), True, "Open"),
            ("E1", 20240101, money(50), False, "Shipped"),
            ("E1", 20240101, money(10), None, "Cancelled"),
            ("E2", 20240101, money(5), True, "Open"),
        ],
        "entity_id string, time_id int, net_amount_usd decimal(18,2), backlog_flag boolean, order_status string",
    )


def test_backlog(make):
    _, entity, time, _ = dims(make)
    out = keyed(gold.gold_order_backlog(orders(make), entity, time), "business_unit")
    north = out[("North",)]
    assert (north.order_intake, north.backlog_value, north.shipped_revenue) == (money(160), money(100), money(50))
    assert north.book_to_bill_ratio == pytest.approx(3.2)
    assert out[("South",)].shipped_revenue == money(0) and out[("South",)].book_to_bill_ratio is None


def test_aftermarket(make):
    _, entity, time, _ = dims(make)
    service = make(
        [
            ("E1", 20240101, money(40), True),
            ("E1", 20240101, money(24), False),
            ("E1", 20250101, money(9), None),
        ],
        "entity_id string, time_id int, contract_value_usd decimal(18,2), service_attach_flag boolean",
    )
    out = keyed(gold.gold_aftermarket_mix(service, orders(make), entity, time), "fiscal_year")
    assert out[(2024,)].aftermarket_mix_pct == pytest.approx(40) and out[(2024,)].service_attach_rate == 0.5
    assert out[(2025,)].total_revenue is None and out[(2025,)].aftermarket_mix_pct is None
    assert out[(2025,)].service_attach_rate is None


def test_plants_skip_zero_standard_cost(make):
    time = dims(make)[2]
    centers = make([("C1", "P1", "Plant", "X")], "cost_center_id string, plant_id string, plant_name string, plant_country string")
    production = make(
        [("C1", 20240101, 0.8, money(110), money(100), 0.02, 5), ("C1", 20240101, 0.6, money(10), money(0), 0.04, 7)],
        "cost_center_id string, time_id int, utilization_pct double, actual_cost decimal(18,2), "
        "standard_cost decimal(18,2), scrap_rate double, units_produced int",
    ).withColumns({c: F.col(c).cast("decimal(8,4)") for c in ("utilization_pct", "scrap_rate")})
    row = gold.gold_plant_performance(production, centers, time).first()
    assert row.cost_variance_pct == pytest.approx(10) and float(row.utilization_pct) == 0.7
    assert row.total_units == 12


def test_total_revenue_is_preserved(make):
    rows = star(make, REVENUE)
    kept = rows[0].join(rows[2], "entity_id").where(F.col("account_id") == "A1").agg(F.sum("amount_usd")).first()[0]
    assert gold.gold_revenue_summary(*rows).agg(F.sum("revenue_usd")).first()[0] == kept
