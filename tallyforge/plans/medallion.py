"""The table build: landed files to cleaned tables, KPI tables and the forecast."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.quality import orphan_report
from tallyforge.operators.silver import RESCUED_LINES, to_silver_observed
from tallyforge.plans import forecast as fc
from tallyforge.plans import gold
from tallyforge.plans.incremental import SilverVersions
from tallyforge.plans.metrics import forecast_with_actuals
from tallyforge.session import shared_root
from tallyforge.sources.feeds import FEEDS, RESCUED
from tallyforge.sources.warehouse import Warehouse
from tallyforge.streaming.ingest import feed_deliveries, ingest_feed

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """One table of the build: its name, tier, inputs and function."""

    name: str
    tier: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    comment: str = ""
    partition_by: tuple[str, ...] = ()


STAR = (
    "silver_fact_gl_journal",
    "silver_dim_account",
    "silver_dim_entity",
    "silver_dim_time",
    "silver_dim_scenario",
)


def _gold(build: Callable[..., DataFrame], *inputs: str, comment: str) -> TableSpec:
    return TableSpec(build.__name__, "gold", inputs, build, comment, ("fiscal_year",))


# In build order; reports filter on the fiscal year, which is a folder here.
GOLD_TABLES: list[TableSpec] = [
    _gold(
        gold.gold_revenue_summary,
        *STAR,
        comment="Revenue by unit, region, period and scenario",
    ),
    _gold(gold.gold_ebitda_bridge, *STAR, comment="Revenue through costs to EBITDA"),
    _gold(
        gold.gold_cash_flow_summary,
        *STAR[:4],
        comment="Free cash flow and conversion by entity and period",
    ),
    _gold(
        gold.gold_leverage_metrics,
        "silver_fact_debt_schedule",
        "silver_dim_time",
        comment="Net leverage and interest coverage by period",
    ),
    _gold(
        gold.gold_working_capital,
        "silver_fact_working_capital",
        "silver_dim_entity",
        "silver_dim_time",
        comment="DSO, DPO and inventory turns by entity and period",
    ),
    _gold(
        gold.gold_aftermarket_mix,
        "silver_fact_service",
        "silver_fact_orders",
        "silver_dim_entity",
        "silver_dim_time",
        comment="Aftermarket revenue share and service attach rate",
    ),
    _gold(
        gold.gold_order_backlog,
        "silver_fact_orders",
        "silver_dim_entity",
        "silver_dim_time",
        comment="Order intake, backlog and book-to-bill by unit",
    ),
    _gold(
        gold.gold_plant_performance,
        "silver_fact_production",
        "silver_dim_cost_center",
        "silver_dim_time",
        comment="Plant utilisation, cost variance and scrap rate",
    ),
]


def build_bronze(spark: SparkSession, landing: str, bronze_root: str) -> dict[str, DataFrame]:
    """Ingest whatever has landed for every feed."""
    return {name: ingest_feed(spark, feed, landing, bronze_root) for name, feed in FEEDS.items()}


def build_silver(
    warehouse: Warehouse, bronze: Tables, feeds: Sequence[str] | None = None
) -> dict[str, dict[str, int]]:
    """Write the cleaned tables; returns the violation counts of each.

    The counts are also appended to ``expectation_log``, one row per rule.
    """
    counts = {}
    for name in feeds or FEEDS:
        feed = FEEDS[name]
        clean, casts, rules = to_silver_observed(bronze[name], feed)
        warehouse.write(feed.silver_table, clean, "silver", f"Cleaned {name} rows")
        counts[feed.silver_table] = {**casts.get, **rules.get}
        if RESCUED in bronze[name].columns:
            counts[feed.silver_table][RESCUED_LINES] = bronze[name].where(F.col(RESCUED).isNotNull()).count()
    _log_counts(warehouse, counts)
    return counts


def refresh_silver(
    warehouse: Warehouse, bronze_root: str, feeds: Sequence[str] | None = None
) -> dict[str, dict[str, int]]:
    """Bring the cleaned tables up to date from the batches that landed since the last refresh.

    Returns and logs the violation counts of the rows taken in. A warehouse uses this or ``build_silver``: here the tables
    are views over versioned buckets.
    """
    counts = {}
    for name in feeds or FEEDS:
        feed = FEEDS[name]
        deliveries = feed_deliveries(warehouse.spark, feed, bronze_root)
        counts[feed.silver_table] = SilverVersions(warehouse, feed).refresh(deliveries)
    _log_counts(warehouse, counts)
    return counts


def _log_counts(warehouse: Warehouse, counts: dict[str, dict[str, int]]) -> None:
    entries = [
        (table, rule, found["rows"], failed)
        for table, found in counts.items()
        for rule, failed in found.items()
        if rule != "rows"
    ]
    log = warehouse.spark.createDataFrame(
        entries, "table_name string, expectation string, row_count bigint, failed bigint"
    )
    warehouse.append("expectation_log", log.withColumn("logged_at", F.current_timestamp()))


# Key columns of the star and the table that must hold their values.
REFERENCES = {
    "entity_id": ("silver_dim_entity", "entity_id"),
    "account_id": ("silver_dim_account", "account_id"),
    "scenario_id": ("silver_dim_scenario", "scenario_id"),
    "time_id": ("silver_dim_time", "time_id"),
    "product_id": ("silver_dim_product", "product_id"),
    "customer_id": ("silver_dim_customer", "customer_id"),
    "cost_center_id": ("silver_dim_cost_center", "cost_center_id"),
    "currency_code": ("silver_dim_currency", "currency_code"),
    "from_currency": ("silver_dim_currency", "currency_code"),
    "to_currency": ("silver_dim_currency", "currency_code"),
}


def build_orphan_report(warehouse: Warehouse) -> DataFrame:
    """Write the keys of the cleaned tables that no dimension row answers, as counts for each column."""
    checks = {}
    # One frame for each table, so that the report scans it once.
    tables = {feed.silver_table: warehouse[feed.silver_table] for feed in FEEDS.values()}
    for feed in FEEDS.values():
        for column, _ in feed.columns:
            table, key = REFERENCES.get(column, (feed.silver_table, column))
            if table != feed.silver_table:
                checks[f"{feed.silver_table}.{column}"] = (
                    tables[feed.silver_table],
                    tables[table],
                    column,
                    key,
                )
    warehouse.write("fk_orphan_report", orphan_report(checks), "silver", "Keys without a dimension row")
    return warehouse["fk_orphan_report"]


def build_gold(warehouse: Warehouse, names: Sequence[str] | None = None) -> None:
    """Write the KPI tables from the cleaned ones."""
    for spec in GOLD_TABLES:
        if names is None or spec.name in names:
            frame = spec.build(*[warehouse[name] for name in spec.inputs])
            warehouse.write(spec.name, frame, spec.tier, spec.comment, spec.partition_by)


def model_path(warehouse: Warehouse) -> str:
    """Folder of the fitted model in the shared folder."""
    return f"{shared_root(warehouse.spark).rstrip('/')}/models/{warehouse.database}/revenue_forecast"


def build_forecast(
    warehouse: Warehouse,
    params: fc.TreeParams | None = None,
    series_keys: Sequence[str] = fc.SERIES_KEYS,
    gap_aware: bool = False,
) -> DataFrame:
    """Train on the cleaned orders, write the forecast and return it.

    Fold metrics, feature attribution and the forecast beside the actuals are written as tables of their own; the
    fitted model is saved at ``model_path``.
    """
    features = fc.forecast_features(
        warehouse["silver_fact_orders"],
        warehouse["silver_dim_entity"],
        warehouse["silver_dim_product"],
        warehouse["silver_dim_time"],
        warehouse["gold_plant_performance"],
        warehouse["silver_fact_fx_rates"],
        series_keys,
        gap_aware,
    )
    training = fc.materialise(fc.training_set(features, series_keys), "training-set")
    models = fc.train_with_folds(training, params)
    model = models[0]
    scored = fc.score_forecast(model, training, series_keys)
    warehouse.write("ml_revenue_forecast", scored, "gold", "Revenue forecast by series and month")
    compared = forecast_with_actuals(
        warehouse["ml_revenue_forecast"], warehouse["silver_dim_entity"], warehouse["gold_revenue_summary"]
    )
    warehouse.write("forecast_with_actuals", compared, "gold", "Forecast beside actual revenue")
    folds = fc.cross_validate(training, params, models=models)
    warehouse.write("ml_cv_metrics", folds, "gold", "Forecast errors by validation fold")
    shares = fc.feature_importance(model, training)
    warehouse.write("ml_feature_importance", shares, "gold", "Share of each feature in the forecast")
    model.save(warehouse.spark, model_path(warehouse))
    return warehouse["ml_revenue_forecast"]


def run_all(
    spark: SparkSession,
    landing: str,
    bronze_root: str,
    warehouse: Warehouse,
    params: fc.TreeParams | None = None,
    series_keys: Sequence[str] = fc.SERIES_KEYS,
    incremental: bool = False,
) -> dict[str, dict[str, int]]:
    """Ingest, clean, aggregate and forecast; returns the violation counts.

    With ``incremental`` the cleaned tables take in what has landed since the last run, without a rebuild.
    """
    bronze = build_bronze(spark, landing, bronze_root)
    counts = refresh_silver(warehouse, bronze_root) if incremental else build_silver(warehouse, bronze)
    build_orphan_report(warehouse)
    build_gold(warehouse)
    build_forecast(warehouse, params, series_keys)
    return counts
