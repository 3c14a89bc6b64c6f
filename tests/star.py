"""A small star schema with known answers."""

from decimal import Decimal

ENTITIES = [
    ("E1", "Alpha", "North", "Europe", False),
    ("E2", "Beta", "South", "Asia", False),
    ("E3", "Group", "North", "Europe", True),
]
ACCOUNTS = [
    ("A1", "Revenue", "REV"),
    ("A2", "COGS", "COGS_MAT"),
    ("A3", "OpEx", "OPEX_RD"),
    ("A4", "BS", "BS_CASH"),
    ("A5", "CF", "CF_OPS"),
    ("A6", "CF", "CF_INV"),
]
SCENARIOS = [("S1", "Actual"), ("S2", "Budget"), ("S3", "Forecast")]
PERIODS = [
    (20240101, 2024, "Q1", 1),
    (20240201, 2024, "Q1", 2),
    (20240401, 2024, "Q2", 4),
    (20250101, 2025, "Q1", 1),
    (20250201, 2025, "Q1", 2),
    (20260101, 2026, "Q1", 1),
]


def money(value):
    return Decimal(str(value)).quantize(Decimal("0.01"))


def dims(make):
    return (
        make(ACCOUNTS, "account_id string, account_type string, account_group string"),
        make(
            ENTITIES,
            "entity_id string, entity_name string, business_unit string, region string, "
            "is_consolidated boolean",
        ),
        make(PERIODS, "time_id int, fiscal_year int, fiscal_quarter string, fiscal_month int"),
        make(SCENARIOS, "scenario_id string, scenario_name string"),
    )


def journal(make, rows):
    """Rows of (entity, account, scenario, time, amount)."""
    return make(
        [(e, a, s, t, money(v)) for e, a, s, t, v in rows],
        "entity_id string, account_id string, scenario_id string, time_id int, "
        "amount_usd decimal(18,2)",
    )
