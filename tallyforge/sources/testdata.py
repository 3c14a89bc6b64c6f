"""Planning tables built from a generic order-and-line-item data set.

``SampleTables`` answers to the cleaned and KPI table names, and builds each
from the parquet files on demand. ``bronze_rows`` gives the same facts as raw
text deliveries, repeats included, for the cleaning step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.calendar import (
    calendar_dim,
    date_key,
    period_key,
    with_fiscal_columns,
)
from tallyforge.functions.measures import (
    average_rate,
    monthly_interest,
    receivable_aging,
    remaining_spend,
)
from tallyforge.operators.dedup import dedup_latest
from tallyforge.plans import metrics
from tallyforge.plans.medallion import GOLD_TABLES, TableSpec
from tallyforge.sources.feeds import INGESTED_AT, SOURCE_FILE, Feed

# Fixed values of the mapping below. Kinds that the data may have beside these get OTHER in their place.
OTHER, UNASSIGNED = "?", "Unassigned"
ACCOUNTS = {
    "RO": ("Revenue", "REV_PROD"),
    "AO": ("COGS", "COGS_MAT"),
    "NO": ("OpEx", "OPEX_SGA"),
    "?O": (UNASSIGNED, UNASSIGNED),
    "RF": ("CF", "CF_OPS"),
    "AF": ("CF", "CF_INV"),
    "NF": ("CF", "CF_FIN"),
    "?F": ("CF", UNASSIGNED),
}
SCENARIOS = {
    "1-URGENT": "Actual",
    "2-HIGH": "Budget",
    "3-MEDIUM": "Forecast",
    "4-NOT SPECIFIED": "Upside",
    "5-LOW": "Downside",
    OTHER: UNASSIGNED,
}
ORDER_STATUS = {"O": "Open", "F": "Shipped", "P": "Cancelled"}
AFTERMARKET_TYPES = ["PROMO", "SMALL"]
YEARLY_RATE = "0.055"

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = [
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def _lookup(value: Column, table: Mapping[str, str]) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, text in table.items():
        out = out.when(value == key, F.lit(text))
    return out


def _listed_account() -> Column:
    """Account of a line: finished lines are cash, all others accruals; null and unknown flags count as OTHER.

    Every line has one of ACCOUNTS, so the join with the inline dimension loses none.
    """
    flag = F.col("l_returnflag")
    known = F.when(flag.isin("R", "A", "N"), flag).otherwise(F.lit(OTHER))
    return F.concat(known, F.when(F.col("l_linestatus") == "F", F.lit("F")).otherwise(F.lit("O")))


def _listed_scenario() -> Column:
    """Scenario of an order: its priority, or OTHER where that is null or unknown."""
    priority = F.col("o_orderpriority")
    return F.when(priority.isin(list(SCENARIOS)), priority).otherwise(F.lit(OTHER))


def _small_table(spark: SparkSession, rows: Sequence[tuple[str, ...]], names: str) -> DataFrame:
    # An inline table has a known size, so a join with it is planned as a broadcast.
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def _rounded_quotient(num: Column, den: Column, unit: str) -> Column:
    # Whole units with halves upward; the doubles hold these integers exactly.
    whole = F.floor((num * 2 + den) / (den * 2))
    scale = len(unit) - 2
    return (whole.cast("decimal(18,0)") * F.lit(unit).cast(f"decimal(3,{scale})")).cast(
        f"decimal(18,{scale})"
    )


def _cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def _unit_price(price: Column, quantity: Column) -> Column:
    return _rounded_quotient(_cents(price), quantity.cast("bigint"), "0.01")


def _turns() -> Column:
    """Line price over ten retail prices."""
    price, stock = _cents(F.col("l_extendedprice")) * 10, _cents(F.col("p_retailprice"))
    return _rounded_quotient(price, stock, "0.01").cast("decimal(8,2)")


class SampleTables(Mapping):
    """Cleaned (``silver_``) and KPI (``gold_``) tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Frames by name: opening a parquet folder lists files and reads a footer.
        self._frames: dict[str, DataFrame] = {}
        self._calendar: tuple[date, date] | None = None
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "silver_dim_entity": self.dim_entity,
            "silver_dim_account": self.dim_account,
            "silver_dim_scenario": self.dim_scenario,
            "silver_dim_time": self.dim_time,
            "silver_dim_product": self.dim_product,
            "silver_dim_cost_center": self.dim_cost_center,
            "silver_fact_gl_journal": self.fact_gl_journal,
            "silver_fact_orders": self.fact_orders,
            "silver_fact_production": self.fact_production,
            "silver_fact_service": self.fact_service,
            "silver_fact_working_capital": self.fact_working_capital,
            "silver_fact_debt_schedule": self.fact_debt_schedule,
            "silver_fact_fx_rates": self.fact_fx_rates,
            "silver_fact_capex": self.fact_capex,
            "ml_revenue_forecast": self.planned_forecast,
            "forecast_with_actuals": lambda: metrics.forecast_with_actuals(
                self["ml_revenue_forecast"], self["silver_dim_entity"], self["gold_revenue_summary"]
            ),
        }
        self._builders |= {spec.name: partial(self._kpi_table, spec) for spec in GOLD_TABLES}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    def _kpi_table(self, spec: TableSpec) -> DataFrame:
        return spec.build(*[self[name] for name in spec.inputs])

    def __getitem__(self, name: str) -> DataFrame:
        return self._once(name, self._builders[name])

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder.rstrip('/')}/{name}.parquet"
        return self._once(f"raw_{name}", lambda: self.spark.read.parquet(path))

    def star(self) -> tuple[DataFrame, ...]:
        names = ("fact_gl_journal", "dim_account", "dim_entity", "dim_time", "dim_scenario")
        return tuple(self[f"silver_{name}"] for name in names)

    # Dimensions -------------------------------------------------------------

    def places(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", "n_name", "r_name"
        )

    def dim_entity(self) -> DataFrame:
        customer, places = self.raw("customer"), self.places()
        return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
            F.col("c_custkey").alias("entity_id"),
            F.col("c_name").alias("entity_name"),
            F.col("c_mktsegment").alias("business_unit"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            (F.col("c_acctbal") < 0).alias("is_consolidated"),
        )

    def dim_account(self) -> DataFrame:
        rows = [(key, kind, group) for key, (kind, group) in ACCOUNTS.items()]
        return _small_table(self.spark, rows, "account_id, account_type, account_group")

    def dim_scenario(self) -> DataFrame:
        return _small_table(self.spark, list(SCENARIOS.items()), "scenario_id, scenario_name")

    def dim_time(self) -> DataFrame:
        """Every day of the years that the facts' dates touch."""
        if self._calendar is None:
            days = self.raw("lineitem").agg(F.min(_day("l_shipdate")).alias("lo"), F.max(_day("l_shipdate")).alias("hi"))
            placed = self.raw("orders").agg(F.min(_day("o_orderdate")), F.max(_day("o_orderdate")))
            lo, hi = days.union(placed).agg(F.min("lo"), F.max("hi")).first()
            lo, hi = lo or date(2000, 1, 1), hi or date(2000, 12, 31)
            self._calendar = date(lo.year, 1, 1), date(hi.year, 12, 31)
        return calendar_dim(self.spark, *self._calendar)

    def dim_product(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_brand").alias("product_family"),
            F.col("p_type").alias("product_line"),
            F.concat(F.lit("EM"), (F.col("p_size") % 6).cast("string")).alias("end_market"),
            F.col("p_type").isin(AFTERMARKET_TYPES).alias("is_aftermarket"),
        )

    def dim_cost_center(self) -> DataFrame:
        supplier, places = self.raw("supplier"), self.places()
        return supplier.join(places, supplier.s_nationkey == places.n_nationkey).select(
            F.col("s_suppkey").alias("cost_center_id"),
            F.col("s_nationkey").alias("plant_id"),
            F.col("n_name").alias("plant_name"),
            F.col("r_name").alias("plant_country"),
        )

    # Facts ------------------------------------------------------------------

    def lines(self) -> DataFrame:
        """Line items, latest version of each; rows without a full key are dropped.

        The key filter is the same for every fact, so that one query with
        several facts reads and shuffles the line items once.
        """

        def build() -> DataFrame:
            latest = dedup_latest(self.raw("lineitem"), LINE_KEY, ["l_shipdate"], LINE_TIES)
            return latest.where(F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull())

        return self._once("lines", build)

    def _with_orders(self, lines: DataFrame, *columns: str) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", *columns)
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey)

    def fact_gl_journal(self) -> DataFrame:
        return self._with_orders(self.lines(), "o_custkey", "o_orderpriority").select(
            F.col("l_orderkey"),
            F.col("l_linenumber"),
            F.col("o_custkey").alias("entity_id"),
            _listed_account().alias("account_id"),
            _listed_scenario().alias("scenario_id"),
            date_key(F.col("l_shipdate")).alias("time_id"),
            _money(F.col("l_extendedprice")).alias("amount_usd"),
        )

    def _order_lines(self) -> DataFrame:
        return self._with_orders(self.lines(), "o_custkey", "o_orderdate", "o_orderstatus")

    @staticmethod
    def _order_columns() -> list[Column]:
        kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
        return [
            F.col("o_custkey").alias("entity_id"),
            F.col("l_partkey").alias("product_id"),
            date_key(F.col("o_orderdate")).alias("time_id"),
            _money(_money(F.col("l_extendedprice")) * kept).alias("net_amount_usd"),
        ]

    def fact_orders(self) -> DataFrame:
        return self._order_lines().select(
            "l_orderkey",
            "l_linenumber",
            *self._order_columns(),
            F.col("l_quantity").cast("int").alias("order_qty"),
            _unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
            F.col("l_discount").cast("decimal(8,4)").alias("discount_pct"),
            _lookup(F.col("o_orderstatus"), ORDER_STATUS).alias("order_status"),
            (F.col("o_orderstatus") == "O").alias("backlog_flag"),
        )

    def fact_service(self) -> DataFrame:
        aftermarket = self.dim_product().where("is_aftermarket").select("product_id")
        contracts = self._order_lines().select(
            *self._order_columns(),
            F.col("l_returnflag").alias("contract_type"),
            (F.col("l_linestatus") == "F").alias("service_attach_flag"),
        )
        return contracts.withColumnRenamed("net_amount_usd", "contract_value_usd").join(
            aftermarket, "product_id"
        )

    def _with_parts(self, lines: DataFrame) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_retailprice")
        return lines.join(part, lines.l_partkey == part.p_partkey)

    def fact_production(self) -> DataFrame:
        standard = _money(F.col("p_retailprice")) * F.col("l_quantity").cast("decimal(6,0)")
        tax = F.col("l_tax").cast("decimal(4,2)")
        return self._with_parts(self.lines()).select(
            F.col("l_suppkey").alias("cost_center_id"),
            F.col("l_partkey").alias("product_id"),
            date_key(F.col("l_shipdate")).alias("time_id"),
            F.col("l_quantity").cast("int").alias("units_produced"),
            _money(standard).alias("standard_cost"),
            _money(F.col("l_extendedprice")).alias("actual_cost"),
            (F.lit(1).cast("decimal(4,2)") - tax * F.lit("7.5").cast("decimal(2,1)"))
            .cast("decimal(8,4)")
            .alias("utilization_pct"),
            F.col("l_discount").cast("decimal(8,4)").alias("scrap_rate"),
        )

    @staticmethod
    def _dso() -> Column:
        gap = F.datediff(_day("l_shipdate"), _day("o_orderdate"))
        return (F.abs(gap) % 60 + 30).cast("decimal(8,1)")

    def fact_working_capital(self) -> DataFrame:
        return self._with_parts(self._with_orders(self.lines(), "o_custkey", "o_orderdate")).select(
            F.col("o_custkey").alias("entity_id"),
            date_key(F.col("l_shipdate")).alias("time_id"),
            self._dso().alias("dso"),
            F.col("l_quantity").cast("decimal(8,1)").alias("dpo"),
            _turns().alias("inventory_turns"),
        )

    def fact_debt_schedule(self) -> DataFrame:
        balance = F.col("o_totalprice")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("debt_id"),
            F.col("o_custkey").alias("entity_id"),
            date_key(F.col("o_orderdate")).alias("time_id"),
            _money(balance).alias("principal_balance"),
            monthly_interest(balance, F.lit(YEARLY_RATE)).alias("interest_expense"),
        )

    def fact_fx_rates(self) -> DataFrame:
        spot = F.lit(1).cast("decimal(12,6)") + F.col("l_tax").cast("decimal(12,6)")
        budget = F.lit(1).cast("decimal(12,6)")
        return self.lines().select(
            F.col("l_returnflag").alias("from_currency"),
            date_key(F.col("l_shipdate")).alias("time_id"),
            spot.cast("decimal(12,6)").alias("spot_rate"),
            budget.alias("budget_rate"),
            average_rate(spot, budget).alias("avg_rate"),
        )

    def fact_capex(self) -> DataFrame:
        approved = _money(F.col("l_extendedprice"))
        spent = _money(approved * F.col("l_discount").cast("decimal(4,2)") * F.lit(10))
        return self._with_orders(self.lines(), "o_custkey").select(
            F.col("o_custkey").alias("entity_id"),
            F.col("l_suppkey").alias("cost_center_id"),
            date_key(F.col("l_shipdate")).alias("time_id"),
            approved.alias("approved_amount"),
            spent.alias("spent_amount"),
            remaining_spend(approved, spent).alias("forecast_amount"),
        )

    def planned_forecast(self) -> DataFrame:
        """Journal amounts of the Forecast scenario as a forecast table.

        It has the columns of the model's output, so that the forecast reports
        can be compared with plain SQL.
        """
        orders = self.raw("orders").where(F.col("o_orderpriority") == "3-MEDIUM")
        lines = self.lines()
        rows = lines.join(
            orders.select("o_orderkey", "o_custkey"), lines.l_orderkey == orders.o_orderkey
        )
        part = self.raw("part").select("p_partkey", "p_brand")
        ship = F.col("l_shipdate")
        predicted = F.col("predicted_revenue")
        return (
            rows.join(part, rows.l_partkey == part.p_partkey)
            .groupBy(
                F.col("o_custkey").alias("entity_id"),
                F.col("p_brand").alias("product_family"),
                period_key(F.year(ship), F.month(ship)).alias("forecast_month"),
            )
            .agg(_money(F.sum(_money(F.col("l_extendedprice")))).alias("predicted_revenue"))
            .select(
                "*",
                _money(predicted * F.lit("0.9").cast("decimal(2,1)")).alias(
                    "prediction_interval_lower"
                ),
                _money(predicted * F.lit("1.1").cast("decimal(2,1)")).alias(
                    "prediction_interval_upper"
                ),
            )
        )


# Raw deliveries ---------------------------------------------------------------


def _texts(columns: Mapping[str, Column | str | None]) -> list[Column]:
    def value(v: Column | str | None) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return [value(v).cast("string").alias(name) for name, v in columns.items()]


def bronze_rows(tables: SampleTables, feed: Feed) -> DataFrame:
    """Deliveries of one feed as text, with ingest time and file name."""
    rows, stamp, columns = _DELIVERIES[feed.name](tables)
    return rows.select(
        *_texts({name: columns[name] for name, _ in feed.columns}),
        stamp.cast("timestamp").alias(INGESTED_AT),
        F.lit(feed.glob).alias(SOURCE_FILE),
    )


def _line_id(prefix: str) -> Column:
    return F.concat(
        F.lit(prefix), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber")
    )


def _entity_rows(t: SampleTables):
    rows = t.raw("customer").join(t.places(), F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        rows,
        F.lit("2002-01-01"),
        {
            "entity_id": F.col("c_custkey"),
            "entity_name": F.col("c_name"),
            "parent_entity_id": None,
            "region": F.col("r_name"),
            "country": F.col("n_name"),
            "business_unit": F.col("c_mktsegment"),
            "is_consolidated": F.col("c_acctbal") < 0,
            "currency_code": "USD",
        },
    )


def _account_rows(t: SampleTables):
    key = F.concat("l_returnflag", "l_linestatus")
    kinds = {k: kind for k, (kind, _) in ACCOUNTS.items()}
    groups = {k: group for k, (_, group) in ACCOUNTS.items()}
    kind = _lookup(key, kinds)
    return (
        t.raw("lineitem"),
        F.col("l_shipdate"),
        {
            "account_id": key,
            "account_name": F.concat(F.lit("Account "), key),
            "account_type": kind,
            "account_group": _lookup(key, groups),
            "parent_account_id": F.col("l_linestatus"),
            "sign_convention": F.when(kind == "Revenue", "credit").otherwise("debit"),
            "is_calculated": F.lit(False),
        },
    )


def _scenario_id() -> Column:
    year = F.year("o_orderdate").cast("string")
    return F.concat(F.lit("S"), year, F.left("o_orderpriority", F.lit(1)))


def _scenario_rows(t: SampleTables):
    return (
        t.raw("orders"),
        F.col("o_orderdate"),
        {
            "scenario_id": _scenario_id(),
            "scenario_name": _lookup(F.col("o_orderpriority"), SCENARIOS),
            "scenario_year": F.year("o_orderdate"),
            "is_locked": F.col("o_orderstatus") == "F",
        },
    )


def _time_rows(t: SampleTables):
    shipped = t.raw("lineitem").select(_day("l_shipdate").alias("calendar_date"))
    ordered = t.raw("orders").select(_day("o_orderdate").alias("calendar_date"))
    rows = with_fiscal_columns(shipped.unionByName(ordered))
    return rows, F.col("calendar_date"), {c: F.col(c) for c in rows.columns}


def _product_rows(t: SampleTables):
    rows = t.dim_product()
    return rows, F.lit("2002-01-01"), {c: F.col(c) for c in rows.columns}


def _customer_rows(t: SampleTables):
    rows = t.raw("customer").join(t.places(), F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        rows,
        F.lit("2002-01-01"),
        {
            "customer_id": F.col("c_custkey"),
            "customer_name": F.col("c_name"),
            "customer_segment": F.when(F.col("c_acctbal") >= 5000, "Enterprise").otherwise("SMB"),
            "region": F.col("r_name"),
            "country": F.col("n_name"),
            "industry_vertical": F.col("c_mktsegment"),
        },
    )


def _currency_rows(t: SampleTables):
    return (
        t.raw("lineitem"),
        F.col("l_shipdate"),
        {
            "currency_code": F.col("l_returnflag"),
            "currency_name": F.concat(F.lit("Currency "), F.col("l_linestatus")),
        },
    )


def _cost_center_rows(t: SampleTables):
    rows = t.raw("supplier").join(t.places(), F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        rows,
        F.lit("2002-01-01"),
        {
            "cost_center_id": F.col("s_suppkey"),
            "cost_center_name": F.col("s_name"),
            "plant_id": F.col("s_nationkey"),
            "plant_name": F.col("n_name"),
            "plant_country": F.col("r_name"),
        },
    )


def _gl_rows(t: SampleTables):
    rows = t._with_orders(t.raw("lineitem"), "o_custkey", "o_orderdate", "o_orderpriority")
    amount = _money(F.col("l_extendedprice"))
    return (
        rows,
        F.col("l_shipdate"),
        {
            "journal_id": _line_id("J"),
            "entity_id": F.col("o_custkey"),
            "account_id": F.concat("l_returnflag", "l_linestatus"),
            "scenario_id": _scenario_id(),
            "time_id": date_key(F.col("l_shipdate")),
            "flow_type": "Operating",
            "intercompany_entity_id": None,
            "amount_local": amount,
            "amount_usd": amount,
            "currency_code": F.col("l_returnflag"),
        },
    )


def _order_rows(t: SampleTables):
    rows = t._with_orders(t.raw("lineitem"), "o_custkey", "o_orderdate", "o_orderstatus")
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return (
        rows,
        F.col("l_shipdate"),
        {
            "order_id": _line_id("O"),
            "entity_id": F.col("o_custkey"),
            "customer_id": F.col("o_custkey"),
            "product_id": F.col("l_partkey"),
            "time_id": date_key(F.col("o_orderdate")),
            "order_qty": F.col("l_quantity").cast("int"),
            "unit_price": _unit_price(F.col("l_extendedprice"), F.col("l_quantity")),
            "discount_pct": F.col("l_discount").cast("decimal(8,4)"),
            "net_amount_usd": _money(_money(F.col("l_extendedprice")) * kept),
            "order_status": _lookup(F.col("o_orderstatus"), ORDER_STATUS),
            "backlog_flag": F.col("o_orderstatus") == "O",
        },
    )


def _production_rows(t: SampleTables):
    rows = t._with_parts(t.raw("lineitem"))
    units = F.col("l_quantity").cast("int")
    price = _money(F.col("l_extendedprice"))
    tax = F.col("l_tax").cast("decimal(4,2)")
    utilization = F.lit(1).cast("decimal(4,2)") - tax * F.lit("7.5").cast("decimal(2,1)")
    return (
        rows,
        F.col("l_shipdate"),
        {
            "production_id": _line_id("PR"),
            "cost_center_id": F.col("l_suppkey"),
            "product_id": F.col("l_partkey"),
            "time_id": date_key(F.col("l_shipdate")),
            "units_produced": units,
            "standard_cost": _money(_money(F.col("p_retailprice")) * units.cast("decimal(6,0)")),
            "actual_cost": price,
            "utilization_pct": utilization.cast("decimal(8,4)"),
            "energy_cost": _money(price * F.lit("0.1").cast("decimal(2,1)")),
            "material_cost": _money(price * F.lit("0.6").cast("decimal(2,1)")),
            "scrap_rate": F.col("l_discount").cast("decimal(8,4)"),
        },
    )


def _service_rows(t: SampleTables):
    parts = t.raw("part").where(F.col("p_type").isin(AFTERMARKET_TYPES)).select("p_partkey")
    rows = t._with_orders(t.raw("lineitem"), "o_custkey", "o_orderdate", "o_orderstatus")
    rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    value = _money(_money(F.col("l_extendedprice")) * kept)
    return (
        rows,
        F.col("l_shipdate"),
        {
            "service_id": _line_id("SV"),
            "entity_id": F.col("o_custkey"),
            "customer_id": F.col("o_custkey"),
            "product_id": F.col("l_partkey"),
            "time_id": date_key(F.col("o_orderdate")),
            "contract_type": F.col("l_returnflag"),
            "contract_value_usd": value,
            "parts_revenue_usd": _money(value * F.lit("0.5").cast("decimal(2,1)")),
            "labor_revenue_usd": _money(value * F.lit("0.2").cast("decimal(2,1)")),
            "is_renewal": F.col("l_quantity") > 25,
            "churn_flag": F.col("o_orderstatus") == "P",
            "service_attach_flag": F.col("l_linestatus") == "F",
        },
    )


def _working_capital_rows(t: SampleTables):
    rows = t._with_parts(t._with_orders(t.raw("lineitem"), "o_custkey", "o_orderdate"))
    balance = _money(F.col("l_extendedprice"))
    return (
        rows,
        F.col("l_shipdate"),
        {
            "wc_id": _line_id("WC"),
            "entity_id": F.col("o_custkey"),
            "time_id": date_key(F.col("l_shipdate")),
            "ar_balance": balance,
            **receivable_aging(balance),
            "ap_balance": _money(balance * F.lit("0.5").cast("decimal(2,1)")),
            "inventory_raw": _money(F.col("p_retailprice") * 5),
            "inventory_wip": _money(F.col("p_retailprice") * 3),
            "inventory_finished": _money(F.col("p_retailprice") * 2),
            "dso": t._dso(),
            "dpo": F.col("l_quantity").cast("decimal(8,1)"),
            "inventory_turns": _turns(),
        },
    )


def _debt_rows(t: SampleTables):
    return (
        t.raw("orders"),
        F.col("o_orderdate"),
        {
            "debt_id": F.concat(F.lit("D"), F.col("o_orderkey").cast("string")),
            "entity_id": F.col("o_custkey"),
            "time_id": date_key(F.col("o_orderdate")),
            "instrument_type": F.col("o_orderpriority"),
            "principal_balance": _money(F.col("o_totalprice")),
            "interest_rate": F.lit(YEARLY_RATE).cast("decimal(8,6)"),
            "interest_expense": monthly_interest(F.col("o_totalprice"), F.lit(YEARLY_RATE)),
            "maturity_date": F.add_months(_day("o_orderdate"), 60),
        },
    )


def _fx_rows(t: SampleTables):
    one = F.lit(1).cast("decimal(12,6)")
    spot = (one + F.col("l_tax").cast("decimal(12,6)")).cast("decimal(12,6)")
    return (
        t.raw("lineitem"),
        F.col("l_shipdate"),
        {
            # One rate per currency and month; later lines of the month correct it.
            "rate_id": F.concat(
                F.lit("FX"),
                F.col("l_returnflag"),
                (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("string"),
            ),
            "from_currency": F.col("l_returnflag"),
            "to_currency": "USD",
            "time_id": date_key(F.col("l_shipdate")),
            "spot_rate": spot,
            "budget_rate": one,
            "avg_rate": average_rate(spot, one),
        },
    )


def _capex_rows(t: SampleTables):
    rows = t._with_orders(t.raw("lineitem"), "o_custkey")
    approved = _money(F.col("l_extendedprice"))
    spent = _money(approved * F.col("l_discount").cast("decimal(4,2)") * F.lit(10))
    return (
        rows,
        F.col("l_shipdate"),
        {
            "capex_id": _line_id("CX"),
            "entity_id": F.col("o_custkey"),
            "cost_center_id": F.col("l_suppkey"),
            "time_id": date_key(F.col("l_shipdate")),
            "project_name": F.concat(F.lit("Project "), F.col("l_partkey").cast("string")),
            "capex_category": F.col("l_returnflag"),
            "approved_amount": approved,
            "spent_amount": spent,
            "forecast_amount": remaining_spend(approved, spent),
        },
    )


_DELIVERIES = {
    "entity_master": _entity_rows,
    "account_master": _account_rows,
    "scenario_master": _scenario_rows,
    "time_master": _time_rows,
    "product_master": _product_rows,
    "customer_master": _customer_rows,
    "currency_master": _currency_rows,
    "cost_center_master": _cost_center_rows,
    "gl_journal": _gl_rows,
    "orders": _order_rows,
    "production": _production_rows,
    "service": _service_rows,
    "working_capital": _working_capital_rows,
    "debt_schedule": _debt_rows,
    "fx_rates": _fx_rows,
    "capex": _capex_rows,
}
