"""The sixteen landing feeds: columns, types, keys and row rules.

The calls below are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tallyforge.operators.quality import Expectation

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
# The whole text of a line that has too many or too few cells.
RESCUED = "_rescued_data"
# Cells of columns that the feed doesn't declare, by name.
EXTRA = "_extra_columns"


@dataclass(frozen=True)
class Feed:
    """One CSV feed and the cleaned table it becomes."""

    name: str
    table: str
    glob: str
    key: str
    columns: tuple[tuple[str, str], ...]
    rules: tuple[Expectation, ...]

    @property
    def bronze_table(self) -> str:
        return f"bronze_{self.name}"

    @property
    def silver_table(self) -> str:
        return f"silver_{self.table}"

    @property
    def raw_schema(self) -> T.StructType:
        """Text columns: landing keeps what was delivered, silver gives types."""
        return T.StructType([T.StructField(c, T.StringType()) for c, _ in self.columns])


def _feed(name: str, table: str, glob: str, key_rule: str, columns: str, **warn: str) -> Feed:
    fields = tuple(tuple(field.split(" ", 1)) for field in columns.split(", "))
    key = fields[0][0]
    rules = [Expectation(key_rule, f"{key} IS NOT NULL", drops=True)]
    rules += [Expectation(rule, predicate) for rule, predicate in warn.items()]
    return Feed(name, table, glob, key, fields, tuple(rules))


_ALL = [
    _feed(
        "entity_master",
        "dim_entity",
        "entity_master*.csv",
        "valid_entity_id",
        "entity_id string, entity_name string, parent_entity_id string, region string, "
        "country string, business_unit string, is_consolidated boolean, "
        "currency_code string",
        valid_business_unit="business_unit IS NOT NULL",
    ),
    _feed(
        "account_master",
        "dim_account",
        "account_master*.csv",
        "valid_account_id",
        "account_id string, account_name string, account_type string, "
        "account_group string, parent_account_id string, sign_convention string, "
        "is_calculated boolean",
    ),
    _feed(
        "scenario_master",
        "dim_scenario",
        "scenario_master*.csv",
        "valid_scenario_id",
        "scenario_id string, scenario_name string, scenario_year int, is_locked boolean",
    ),
    _feed(
        "time_master",
        "dim_time",
        "time_master*.csv",
        "valid_time_id",
        "time_id int, calendar_date date, fiscal_year int, fiscal_quarter string, "
        "fiscal_month int, fiscal_week int, is_month_end boolean, is_quarter_end boolean",
    ),
    _feed(
        "product_master",
        "dim_product",
        "product_master*.csv",
        "valid_product_id",
        "product_id string, product_family string, product_line string, "
        "end_market string, is_aftermarket boolean",
    ),
    _feed(
        "customer_master",
        "dim_customer",
        "customer_master*.csv",
        "valid_customer_id",
        "customer_id string, customer_name string, customer_segment string, "
        "region string, country string, industry_vertical string",
    ),
    _feed(
        "currency_master",
        "dim_currency",
        "currency_master*.csv",
        "valid_currency",
        "currency_code string, currency_name string",
    ),
    _feed(
        "cost_center_master",
        "dim_cost_center",
        "cost_center_master*.csv",
        "valid_cc_id",
        "cost_center_id string, cost_center_name string, plant_id string, "
        "plant_name string, plant_country string",
    ),
    _feed(
        "gl_journal",
        "fact_gl_journal",
        "gl_journal_*.csv",
        "valid_journal_id",
        "journal_id string, entity_id string, account_id string, scenario_id string, "
        "time_id int, flow_type string, intercompany_entity_id string, "
        "amount_local decimal(18,2), amount_usd decimal(18,2), currency_code string",
        valid_amount="amount_local IS NOT NULL",
        valid_entity_fk="entity_id IS NOT NULL",
    ),
    _feed(
        "orders",
        "fact_orders",
        "orders_*.csv",
        "valid_order_id",
        "order_id string, entity_id string, customer_id string, product_id string, "
        "time_id int, order_qty int, unit_price decimal(18,2), "
        "discount_pct decimal(8,4), net_amount_usd decimal(18,2), order_status string, "
        "backlog_flag boolean",
        positive_qty="order_qty > 0",
    ),
    _feed(
        "production",
        "fact_production",
        "production_*.csv",
        "valid_production_id",
        "production_id string, cost_center_id string, product_id string, time_id int, "
        "units_produced int, standard_cost decimal(18,2), actual_cost decimal(18,2), "
        "utilization_pct decimal(8,4), energy_cost decimal(18,2), "
        "material_cost decimal(18,2), scrap_rate decimal(8,4)",
        valid_units="units_produced >= 0",
    ),
    _feed(
        "service",
        "fact_service",
        "service_*.csv",
        "valid_service_id",
        "service_id string, entity_id string, customer_id string, product_id string, "
        "time_id int, contract_type string, contract_value_usd decimal(18,2), "
        "parts_revenue_usd decimal(18,2), labor_revenue_usd decimal(18,2), "
        "is_renewal boolean, churn_flag boolean, service_attach_flag boolean",
        valid_contract_type="contract_type IS NOT NULL",
    ),
    _feed(
        "working_capital",
        "fact_working_capital",
        "working_capital_*.csv",
        "valid_wc_id",
        "wc_id string, entity_id string, time_id int, ar_balance decimal(18,2), "
        "ar_aging_current decimal(18,2), ar_aging_30 decimal(18,2), "
        "ar_aging_60 decimal(18,2), ar_aging_90plus decimal(18,2), "
        "ap_balance decimal(18,2), inventory_raw decimal(18,2), "
        "inventory_wip decimal(18,2), inventory_finished decimal(18,2), "
        "dso decimal(8,1), dpo decimal(8,1), inventory_turns decimal(8,2)",
        valid_entity_fk="entity_id IS NOT NULL",
    ),
    _feed(
        "debt_schedule",
        "fact_debt_schedule",
        "debt_schedule_*.csv",
        "valid_debt_id",
        "debt_id string, entity_id string, time_id int, instrument_type string, "
        "principal_balance decimal(18,2), interest_rate decimal(8,6), "
        "interest_expense decimal(18,2), maturity_date date",
        valid_principal="principal_balance >= 0",
    ),
    _feed(
        "fx_rates",
        "fact_fx_rates",
        "fx_rates_*.csv",
        "valid_rate_id",
        "rate_id string, from_currency string, to_currency string, time_id int, "
        "spot_rate decimal(12,6), budget_rate decimal(12,6), avg_rate decimal(12,6)",
        positive_rate="spot_rate > 0",
    ),
    _feed(
        "capex",
        "fact_capex",
        "capex_*.csv",
        "valid_capex_id",
        "capex_id string, entity_id string, cost_center_id string, time_id int, "
        "project_name string, capex_category string, approved_amount decimal(18,2), "
        "spent_amount decimal(18,2), forecast_amount decimal(18,2)",
        valid_approved="approved_amount >= 0",
    ),
]

FEEDS: dict[str, Feed] = {feed.name: feed for feed in _ALL}
BY_TABLE: dict[str, Feed] = {feed.silver_table: feed for feed in _ALL}
