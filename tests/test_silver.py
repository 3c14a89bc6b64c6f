from datetime import datetime
from decimal import Decimal

from tallyforge.operators.silver import silver_report, to_silver, to_silver_observed
from tallyforge.sources.feeds import BY_TABLE, FEEDS

NOW = datetime(2026, 1, 1)


def order(order_id, qty="3", price="10.00", stamp=NOW, file="a.csv", status="Open", flag="true"):
    return (
        order_id, "E1", "C1", "P1", "20250101", qty, price, "0.1", "27.00", status, flag, stamp, file,
    )


def bronze(make, rows):
    feed = FEEDS["orders"]
    names = ", ".join(f"{c} string" for c, _ in feed.columns)
    return make(rows, f"{names}, _ingested_at timestamp, _source_file string")


def test_sixteen_feeds_with_a_key_rule_each():
    assert len(FEEDS) == 16
    assert all(f.rules[0].drops and f.rules[0].predicate.startswith(f.key) for f in FEEDS.values())
    assert sum(len(f.rules) - 1 for f in FEEDS.values()) == 10
    assert BY_TABLE["silver_fact_orders"].glob == "orders_*.csv"


def test_types_and_latest_delivery(make):
    later = datetime(2026, 2, 1)
    raw = bronze(make, [order("O1"), order("O1", qty="4", stamp=later), order("O2", price="1.005")])
    silver = {r.order_id: r for r in to_silver(raw, FEEDS["orders"]).collect()}
    assert silver["O1"].order_qty == 4
    assert silver["O1"].unit_price == Decimal("10.00") and silver["O1"].backlog_flag is True
    assert silver["O1"].time_id == 20250101
    assert "_ingested_at" not in to_silver(raw, FEEDS["orders"]).columns


def test_file_delivered_twice_changes_nothing(make):
    raw = bronze(make, [order("O1"), order("O2", qty="1")])
    again = to_silver(raw.unionByName(raw), FEEDS["orders"])
    assert sorted(map(tuple, again.collect())) == sorted(
        map(tuple, to_silver(raw, FEEDS["orders"]).collect())
    )


def test_same_stamp_prefers_the_later_file(make):
    raw = bronze(make, [order("O1", qty="9", file="a.csv"), order("O1", qty="1", file="b.csv")])
    assert to_silver(raw, FEEDS["orders"]).first().order_qty == 1


def test_malformed_cells_become_null_and_are_counted(make):
    raw = bronze(make, [order("O1", qty="many"), order("O2", qty="-1"), order(None), order(None)])
    clean, casts, rules = to_silver_observed(raw, FEEDS["orders"])
    assert sorted(r.order_id for r in clean.collect()) == ["O1", "O2"]
    assert casts.get["castable_order_qty"] == 1 and casts.get["castable_unit_price"] == 0
    # The two rows without a key are one group, so one row is left to drop.
    assert rules.get == {"rows": 3, "valid_order_id": 1, "positive_qty": 2}


def test_undeclared_columns_do_not_leak(make):
    raw = bronze(make, [order("O1")]).selectExpr("*", "'x' AS _rescued_data")
    assert to_silver(raw, FEEDS["orders"]).columns == [c for c, _ in FEEDS["orders"].columns]


def test_report(make):
    raw = bronze(make, [order("O1", qty="0"), order("O2")])
    found = {r.expectation: r.failed for r in silver_report(raw, FEEDS["orders"]).collect()}
    assert found == {"valid_order_id": 0, "positive_qty": 1}
