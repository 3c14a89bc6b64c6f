import pytest
from pyspark.sql import functions as F
from star import money

from tallyforge.operators.periods import at_latest, last_months, last_quarters
from tallyforge.plans.metrics import (
    METRIC_VIEWS,
    forecast_accuracy_aligned,
    forecast_with_actuals,
    metric_parity,
)
from tallyforge.plans.questions import nlq_margin_8q, nlq_rev_q4_yoy
from tallyforge.plans.reports import REPORTS, ReportFilter, report


def revenue(make):
    rows = [
        ("North", "Europe", 2025, "Q1", 1, "Actual", money(100), 10.0, 5.0),
        ("North", "Europe", 2025, "Q1", 2, "Actual", money(50), None, None),
        ("North", "Asia", 2025, "Q4", 12, "Actual", money(70), 20.0, -5.0),
        ("O'Neil", "Asia", 2025, "Q4", 12, "Actual", money(40), 4.0, 1.0),
        ("North", "Europe", 2025, "Q1", 1, "Budget", money(90), None, 0.0),
        ("North", "Europe", 2024, "Q4", 12, "Actual", money(60), None, None),
    ]
    return make(
        rows,
        "business_unit string, region string, fiscal_year int, fiscal_quarter string, fiscal_month int, "
        "scenario_name string, revenue_usd decimal(18,2), yoy_growth_pct double, budget_variance_pct double",
    )


def bridge(make):
    rows = [
        ("North", "Europe", 2025, "Q1", "Actual", money(100), money(-60), money(20), money(160), money(140)),
        ("South", "Asia", 2025, "Q1", "Actual", None, None, None, None, None),
        ("North", "Europe", 2022, "Q4", "Actual", money(10), None, None, money(10), money(10)),
    ]
    return make(
        rows,
        "business_unit string, region string, fiscal_year int, fiscal_quarter string, scenario_name string, "
        "revenue decimal(18,2), cogs decimal(18,2), opex decimal(18,2), gross_profit decimal(18,2), "
        "ebitda decimal(18,2)",
    )


def test_no_restriction_empty_list_and_quote(make):
    tables = {"gold_revenue_summary": revenue(make)}
    assert report("q_rev_by_bu_region", tables).count() == 3
    assert report("q_rev_by_bu_region", tables, ReportFilter(business_unit=[])).count() == 0
    quoted = report("q_rev_by_bu_region", tables, ReportFilter(business_unit=["O'Neil"])).collect()
    assert [r.revenue for r in quoted] == [money(40)]


def test_ordering_and_year(make):
    tables = {"gold_revenue_summary": revenue(make)}
    rows = report("q_rev_by_bu_region", tables, ReportFilter(fiscal_year=2025)).collect()
    assert [r.revenue for r in rows] == [money(150), money(70), money(40)]


def test_heatmap_and_compare(make):
    tables = {"gold_revenue_summary": revenue(make)}
    flt = ReportFilter(fiscal_year=2025)
    heat = {r.business_unit: r for r in report("q_yoy_heatmap", tables, flt).collect()}
    assert heat["North"]["Q1"] == 10 and heat["North"]["Q4"] == 20 and heat["North"]["Q2"] is None
    compared = {(r.scenario_name, r.fiscal_quarter): r.revenue for r in report("q_scenario_compare", tables, flt).collect()}
    assert compared["Budget", "Q1"] == money(90) and compared["Actual", "Q4"] == money(110)


def test_waterfall_uses_cost_sizes(make):
    rows = report("q_ebitda_waterfall", {"gold_ebitda_bridge": bridge(make)}, ReportFilter(fiscal_year=2025)).collect()
    assert [(r.step, r.measure, float(r.amount)) for r in rows] == [
        ("Revenue", "absolute", 100.0),
        ("COGS", "relative", -60.0),
        ("Gross Profit", "total", 0.0),
        ("OpEx", "relative", -20.0),
        ("EBITDA", "total", 0.0),
    ]


def test_every_report_is_named_after_its_function():
    assert len(REPORTS) == 25
    with pytest.raises(KeyError):
        report("nothing", {})


def test_metric_view_recomputes_at_grain(make):
    view = METRIC_VIEWS["mv_ebitda"]
    by_unit = {r["Business Unit"]: r for r in view.query(bridge(make), ["Business Unit"]).collect()}
    assert by_unit["North"]["EBITDA Margin"] == pytest.approx(150 / 110)
    assert by_unit["South"]["EBITDA Margin"] is None
    total = view.query(bridge(make), measures=["EBITDA"], where="fiscal_year = 2025").first()
    assert total.EBITDA == money(140)
    with pytest.raises(KeyError):
        view.query(bridge(make), ["Colour"])


def test_eight_views():
    assert len(METRIC_VIEWS) == 8
    assert sum(len(v.measures) for v in METRIC_VIEWS.values()) == 30


def forecast_parts(make):
    forecast = make(
        [("E1", "F1", "2025-01", 60.0), ("E1", "F2", "2025-01", 90.0), ("E2", "F1", "2025-12", 30.0)],
        "entity_id string, product_family string, forecast_month string, predicted_revenue double",
    )
    entity = make([("E1", "North", "Europe"), ("E2", "North", "Africa")], "entity_id string, business_unit string, region string")
    return forecast, entity, revenue(make)


def test_accuracy_repeats_actuals_and_aligned_does_not(make):
    forecast, entity, rev = forecast_parts(make)
    rows = forecast_with_actuals(forecast, entity, rev)
    view = METRIC_VIEWS["mv_forecast_accuracy"]
    got = {r["Region"]: r for r in view.query(rows, ["Region"]).collect()}
    assert got["Europe"]["Actual Revenue"] == money(200) and got["Europe"]["MAPE"] == pytest.approx(25)
    assert got["Africa"]["Actual Revenue"] is None and got["Africa"]["MAPE"] is None
    aligned = {r["Region"]: r for r in view.query(forecast_accuracy_aligned(forecast, entity, rev), ["Region"]).collect()}
    assert aligned["Europe"]["Actual Revenue"] == money(100) and aligned["Europe"]["MAPE"] == pytest.approx(50)


def test_parity(make):
    nothing = "fiscal_year int, dso double"
    tables = {
        "gold_revenue_summary": revenue(make),
        "gold_ebitda_bridge": bridge(make),
        "gold_working_capital": make([(2025, 3.0), (2025, None)], nothing),
        "gold_aftermarket_mix": make([(2025, 1.0, 0.0)], "fiscal_year int, aftermarket_revenue double, total_revenue double"),
        "gold_order_backlog": make([(2025, 3.0, 2.0)], "fiscal_year int, order_intake double, shipped_revenue double"),
    }
    rows = metric_parity(tables).collect()
    assert all(r.matches for r in rows)
    assert {r.kpi for r in rows} >= {"revenue", "dso", "aftermarket_mix_pct"}


def test_latest_periods(make):
    df = revenue(make)
    assert {(r.fiscal_year, r.fiscal_quarter) for r in last_quarters(df).collect()} == {(2025, "Q4")}
    assert {r.fiscal_quarter for r in last_quarters(df, 5).collect()} == {"Q1", "Q4"}
    assert last_quarters(df, 5).where("fiscal_year = 2024").count() == 1
    assert {r.fiscal_month for r in last_months(df, 11).collect()} == {2, 12}
    assert at_latest(df, "fiscal_year").select(F.max("fiscal_year")).first()[0] == 2025
    assert last_quarters(df.limit(0)).count() == 0


def test_questions(make):
    rows = {r.business_unit: r for r in nlq_rev_q4_yoy({"gold_revenue_summary": revenue(make)}, 2025).collect()}
    assert rows["North"].growth_pct == pytest.approx(100 * 10 / 60)
    assert rows["O'Neil"].prior_revenue is None and rows["O'Neil"].growth_pct is None
    # Eight quarters back from 2025 Q1 ends after 2023 Q1, so 2022 is out.
    margins = nlq_margin_8q({"gold_ebitda_bridge": bridge(make)}).collect()
    assert {(r.region, r.fiscal_year) for r in margins} == {("Europe", 2025), ("Asia", 2025)}
