"""Registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions import calendar as cal
from tallyforge.functions import measures as ms
from tallyforge.functions import text
from tallyforge.operators.dedup import dedup_latest
from tallyforge.operators.quality import (
    Expectation,
    expectation_report,
    keep_valid,
    orphan_report,
)
from tallyforge.operators.silver import silver_report, to_silver
from tallyforge.plans import forecast as fc
from tallyforge.plans import gold, metrics
from tallyforge.plans.incremental import SilverVersions
from tallyforge.plans.medallion import GOLD_TABLES
from tallyforge.plans.questions import QUESTIONS
from tallyforge.plans.reports import REPORTS, ReportFilter
from tallyforge.session import scratch_path, stored
from tallyforge.sources.feeds import FEEDS
from tallyforge.sources.files import deliver_csv, read_csv, write_csv
from tallyforge.sources.testdata import SampleTables, bronze_rows
from tallyforge.sources.warehouse import Warehouse, table_inventory
from tallyforge.streaming.deliveries import Deliveries
from tallyforge.streaming.ingest import feed_deliveries, ingest, read_bronze

try:
    import corpus_pipeline
    from tallyforge.llm.queries import ORACLE_SQL, QUERIES
except ImportError:  # the library also works without its training-data part
    TEXT_QUERIES, TEXT_SQL = {}, {}
else:
    TEXT_QUERIES = QUERIES | {"pipeline": corpus_pipeline.run}
    TEXT_SQL = ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

Query = Callable[[SparkSession, str], DataFrame]

# Report selections: all units and regions, one fiscal year.
YEAR = 2000
SELECTION = ReportFilter(fiscal_year=YEAR, scenario="Actual")

# A customer and brand pair has too few months here for a 12-month lag.
SERIES = ("business_unit", "region", "product_family")


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles, doubles at six places: types that any engine shares."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the revenue summary on the smallest data set."""
    tables = SampleTables(spark, "/root/testdata/sf0.001")
    return present(tables["gold_revenue_summary"])


# Sources and sinks --------------------------------------------------------------


def _text_schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in df.columns])


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def bronze_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the events as CSV, ingest them as a stream, return the typed rows."""
    events = SampleTables(spark, sf_dir).raw("events")
    root = scratch_path(spark, "ingest")
    write_csv(_as_text(events), f"{root}/landing")
    schema = _text_schema(events)
    ingest(spark, f"{root}/landing/*.csv", schema, f"{root}/bronze", f"{root}/checkpoint")
    rows = read_bronze(spark, f"{root}/bronze", schema)
    return rows.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in events.schema.fields],
        F.col("_source_file").isNotNull().alias("has_source"),
        F.col("_ingested_at").isNotNull().alias("has_stamp"),
    )


def _events_landing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, Deliveries]:
    """The events, an empty landing folder, and the deliveries of a feed that declares the events' columns."""
    events = SampleTables(spark, sf_dir).raw("events")
    root = scratch_path(spark, "deliveries")
    return events, f"{root}/landing", Deliveries(spark, _text_schema(events), f"{root}/bronze")


def bronze_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered in three layouts: as declared, in reverse order, and with a new column in place of an old one."""
    events, landing, feed = _events_landing(spark, sf_dir)
    layout = F.pmod(F.col("event_id"), F.lit(3))
    text = _as_text(events)
    wide = text.withColumn("channel", F.concat(F.lit("c"), F.col("user_id"))).drop("value")
    deliver_csv(text.where(layout == 0), landing, "events_declared")
    feed.land_waiting(landing, "events_*.csv")
    deliver_csv(text.where(layout == 1).select(*reversed(text.columns)), landing, "events_reversed")
    deliver_csv(wide.where(layout == 2), landing, "events_wide")
    feed.land_waiting(landing, "events_*.csv")
    return feed.rows().select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in events.schema.fields],
        F.element_at("_extra_columns", F.lit("channel")).alias("channel"),
        F.col("_rescued_data").isNotNull().alias("rescued"),
    )


def bronze_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state of events that come twice under the same names, at first with other values."""
    events, landing, feed = _events_landing(spark, sf_dir)
    text = _as_text(events)
    deliver_csv(text.withColumn("value", F.lit("0.5")).withColumn("event_type", F.lit("draft")), landing, "events")
    feed.land_waiting(landing, "events_*.csv")
    deliver_csv(text, landing, "events")
    feed.land_waiting(landing, "events_*.csv")
    # A third run finds nothing that is new.
    feed.land_waiting(landing, "events_*.csv")
    rows = feed.rows()
    times = F.count(F.lit(1)).over(Window.partitionBy("event_id")).alias("deliveries")
    latest = dedup_latest(rows.select(*text.columns, "_ingested_at", "_batch", times), ["event_id"], ["_batch"])
    return latest.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in events.schema.fields], "deliveries"
    )


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned orders from two deliveries, of which the second corrects and completes the first, refreshed after each."""
    feed = FEEDS["orders"]
    root = scratch_path(spark, "incremental")
    house = Warehouse(spark, root.rsplit("/", 1)[1].replace("-", "_"), f"{root}/tables")
    rows = _as_text(to_silver(bronze_rows(SampleTables(spark, sf_dir), feed), feed))
    late = F.pmod(F.hash(feed.key), F.lit(3))
    deliveries = feed_deliveries(spark, feed, f"{root}/bronze")
    versions = SilverVersions(house, feed)

    def take_in() -> None:
        deliveries.land_waiting(f"{root}/landing", feed.glob, clean=True)
        versions.refresh(deliveries)

    with stored([rows.where(late == 1), rows.where(late == 2)], "orders-text") as final:
        draft = final.where(late == 1).withColumn("net_amount_usd", F.lit("0.01"))
        with stored([rows.where(late == 0)], "orders-text") as early:
            deliver_csv(early.unionByName(draft), f"{root}/landing", "orders_draft")
        take_in()
        deliver_csv(final, f"{root}/landing", "orders_final")
    take_in()
    return house[feed.silver_table]


def sink_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the documents as CSV and read them back: every text as it was."""
    docs = SampleTables(spark, sf_dir).raw("documents")
    path = scratch_path(spark, "csv-text")
    write_csv(docs, path, exact=True)
    return read_csv(spark, path, docs.schema, exact=True)


def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the orders as headered CSV and read them back typed."""
    orders = SampleTables(spark, sf_dir).raw("orders")
    path = scratch_path(spark, "csv")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


INVENTORIED = ["customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier"]


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    found = {name: tables.raw(name) for name in INVENTORIED}
    return table_inventory(spark, found, [*INVENTORIED, "silver_dim_ledger"])


# Quality ----------------------------------------------------------------------------

ACCOUNT_RULES = [
    Expectation("valid_customer", "c_custkey IS NOT NULL", drops=True),
    Expectation("valid_balance", "c_acctbal >= 0", drops=True),
    Expectation("small_balance", "c_acctbal <= 9000"),
]
EVENT_RULES = [
    Expectation("valid_event", "event_id IS NOT NULL", drops=True),
    Expectation("large_value", "value > 10"),
    Expectation("is_purchase", "event_type = 'purchase'"),
]


def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(SampleTables(spark, sf_dir).raw("customer"), ACCOUNT_RULES)


def expect_warn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    customers = expectation_report(tables.raw("customer"), ACCOUNT_RULES, "customer")
    events = expectation_report(tables.raw("events"), EVENT_RULES, "events")
    feed = FEEDS["orders"]
    orders = silver_report(bronze_rows(tables, feed), feed)
    return customers.unionByName(events).unionByName(orders)


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    lines = tables.raw("lineitem")
    leaves = tables.dim_entity().where(~F.col("is_consolidated"))
    aftermarket = tables.dim_product().where("is_aftermarket")
    return orphan_report(
        {
            "line_order": (lines, tables.raw("orders"), "l_orderkey", "o_orderkey"),
            "line_aftermarket_part": (lines, aftermarket, "l_partkey", "product_id"),
            "order_leaf_entity": (tables.raw("orders"), leaves, "o_custkey", "entity_id"),
        }
    )


def dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = SampleTables(spark, sf_dir).raw("events")
    return dedup_latest(events, ["user_id", "event_type"], ["ts"])


# Row-level ----------------------------------------------------------------------------


def filter_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journal rows under every kind of row predicate at once."""
    tables = SampleTables(spark, sf_dir)
    entity = ReportFilter(["BUILDING", "MACHINERY"], ["ASIA", "EUROPE"]).units(tables.dim_entity())
    time = ReportFilter(fiscal_year=YEAR).year(tables.dim_time())
    scenario = tables.dim_scenario().where(F.col("scenario_name") == "Actual")
    return (
        tables.fact_gl_journal()
        .where((F.col("amount_usd") > 1000) & F.col("entity_id").isNotNull())
        .join(
            entity.where(~F.col("is_consolidated") & F.col("entity_name").contains("Customer")),
            "entity_id",
        )
        .join(time.select("time_id", "fiscal_year", "is_month_end"), "time_id")
        .where(~F.col("is_month_end"))
        .join(scenario, "scenario_id")
        .select(
            "l_orderkey",
            "l_linenumber",
            "entity_id",
            "business_unit",
            "region",
            "fiscal_year",
            "amount_usd",
        )
    )


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = SampleTables(spark, sf_dir).raw("orders")
    day = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice")
    year, month = F.year(day), F.month(day)
    later = cal.month_index(year, month) + 7
    return orders.select(
        "o_orderkey",
        cal.date_key(day).alias("time_id"),
        cal.period_key(year, month).alias("period"),
        cal.quarter_number(cal.quarter_label(day)).alias("quarter"),
        cal.period_key(cal.index_year(later), cal.index_month(later)).alias("period_later"),
        F.weekofyear(day).alias("week"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).alias("age_days"),
        F.abs(price - 250000).alias("distance"),
        ms.clamp(price, 50000.0, 300000.0).alias("clamped"),
        F.when(F.col("o_custkey") % 7 == 0, F.lit(1)).otherwise(F.col("o_custkey") % 7).alias("divisor"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        text.slug(F.col("o_orderpriority")).alias("slug"),
        text.currency_label(price).alias("price_label"),
        text.percent_label((F.col("o_custkey") % 1000).cast("double")).alias("share_label"),
    )


def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_spanning(SampleTables(spark, sf_dir).raw("lineitem"), "l_shipdate")


def derived_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    lines = tables.fact_orders()
    price = F.col("unit_price")
    spent = (F.col("net_amount_usd") * F.col("discount_pct")).cast(ms.MONEY)
    spot = F.lit(1) + F.col("discount_pct")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        ms.net_amount(F.col("order_qty"), price, F.col("discount_pct")).alias("net_amount"),
        ms.monthly_interest(F.col("net_amount_usd"), F.lit("0.065")).alias("interest"),
        *[c.alias(n) for n, c in ms.receivable_aging(F.col("net_amount_usd")).items()],
        ms.inventory_turns(F.col("net_amount_usd"), F.col("order_qty")).alias("turns"),
        ms.remaining_spend(F.col("net_amount_usd"), spent).alias("remaining"),
        ms.average_rate(spot, F.lit(1)).alias("avg_rate"),
    )


def _silver(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(to_silver(bronze_rows(SampleTables(spark, sf_dir), FEEDS[name]), FEEDS[name]))

    return run


# KPI tables, metric views, reports -----------------------------------------------------

VIEW_GRAINS = {
    "mv_revenue": ["Business Unit", "Fiscal Year", "Scenario"],
    "mv_ebitda": ["Region", "Fiscal Year", "Fiscal Quarter", "Scenario"],
    "mv_free_cash_flow": ["Region", "Fiscal Year"],
    "mv_leverage": ["Fiscal Year", "Fiscal Quarter"],
    "mv_working_capital": ["Business Unit", "Region", "Fiscal Year"],
    "mv_aftermarket": ["Business Unit", "Fiscal Year"],
    "mv_order_backlog": ["Business Unit", "Fiscal Year", "Fiscal Month"],
    "mv_forecast_accuracy": ["Business Unit", "Region", "Forecast Month"],
}


def _table(name: str) -> Query:
    return lambda spark, sf_dir: present(SampleTables(spark, sf_dir)[name])


def _view(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = metrics.METRIC_VIEWS[name]
        return present(view.query(SampleTables(spark, sf_dir), VIEW_GRAINS[name]))

    return run


def _report(name: str) -> Query:
    return lambda spark, sf_dir: present(REPORTS[name](SampleTables(spark, sf_dir), SELECTION))


def _question(name: str) -> Query:
    options = {"fiscal_year": YEAR} if name == "nlq_rev_q4_yoy" else {}
    return lambda spark, sf_dir: present(
        QUESTIONS[name](SampleTables(spark, sf_dir), **options)
    )


def forecast_accuracy_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    aligned = metrics.forecast_accuracy_aligned(
        tables["ml_revenue_forecast"], tables.dim_entity(), tables["gold_revenue_summary"]
    )
    view = metrics.METRIC_VIEWS["mv_forecast_accuracy"]
    return view.query(aligned, VIEW_GRAINS["mv_forecast_accuracy"])


# Forecast ---------------------------------------------------------------------------------


def _monthly(tables: SampleTables, series_keys=fc.SERIES_KEYS) -> DataFrame:
    return fc.monthly_order_revenue(
        tables.fact_orders(),
        tables.dim_entity(),
        tables.dim_product(),
        tables.dim_time(),
        series_keys,
    )


def _series(tables: SampleTables) -> DataFrame:
    return fc.series_months(_monthly(tables, SERIES), SERIES)


def _features(tables: SampleTables) -> DataFrame:
    return fc.forecast_features(
        tables.fact_orders(),
        tables.dim_entity(),
        tables.dim_product(),
        tables.dim_time(),
        tables["gold_plant_performance"],
        tables.fact_fx_rates(),
        SERIES,
    )


def _training(tables: SampleTables) -> DataFrame:
    return fc.training_set(_features(tables), SERIES)


def _stored_training(tables: SampleTables) -> DataFrame:
    return fc.materialise(_training(tables), "training-set")


_FITTED: dict[tuple[str, str], tuple[DataFrame, dict[int, fc.BoostedTrees]]] = {}


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[int, fc.BoostedTrees]]:
    """Stored training set of a folder, its model (0) and those of the folds, made once in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        training = _stored_training(SampleTables(spark, sf_dir))
        _FITTED[key] = training, fc.train_with_folds(training)
    return _FITTED[key]


def forget_models() -> None:
    _FITTED.clear()


def ml_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, models = _fitted(spark, sf_dir)
    return models[0].transform(training).select(*SERIES, "period", fc.TARGET, "prediction")


def ml_cv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, models = _fitted(spark, sf_dir)
    return fc.cross_validate(training, models=models)


def ml_cv_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated rows of each fold, as the metrics count them."""
    return ml_cv_metrics(spark, sf_dir).select("fold", "row_count")


def ml_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, models = _fitted(spark, sf_dir)
    return fc.feature_importance(models[0], training)


def ml_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact attribution of the prediction of every training row."""
    training, models = _fitted(spark, sf_dir)
    return fc.attribution(models[0], training, [*SERIES, "period"])


def ml_attribution_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explained rows of each unit, and whether the attributions of all add up to the predictions."""
    total = F.col("base") + F.aggregate("attribution", F.lit(0.0), lambda a, b: a + b)
    close = F.abs(total - F.col("prediction")) <= 1e-9 * F.greatest(F.abs("prediction"), F.lit(1e6))
    explained = ml_attribution(spark, sf_dir).groupBy("business_unit")
    return explained.agg(F.count("*").alias("row_count"), F.bool_and(close).alias("adds_up"))


def ml_importance_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature, and whether both of its shares are possible ones."""
    split = F.col("split_importance")
    return ml_feature_importance(spark, sf_dir).select(
        "feature",
        (F.col("mean_abs_shap") >= 0).alias("has_attribution"),
        split.between(0, 1).alias("has_split_share"),
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, models = _fitted(spark, sf_dir)
    return fc.score_forecast(models[0], training, SERIES)


def ml_forecast_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of every forecast series, and whether its ranges hold the predictions and are equally wide."""
    value, low, high = "predicted_revenue", "prediction_interval_lower", "prediction_interval_upper"
    width = F.col(high) - F.col(low)
    return _scored(spark, sf_dir).groupBy(*SERIES).agg(
        F.countDistinct("forecast_month").alias("months"),
        F.min("forecast_month").alias("first_month"),
        F.max("forecast_month").alias("last_month"),
        F.bool_and(F.col(value).between(F.col(low), F.col(high))).alias("in_range"),
        (F.max(width) - F.min(width) < 0.025).alias("even_width"),
    )


def forecast_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width of the range around every prediction."""
    low, high = F.col("prediction_interval_lower"), F.col("prediction_interval_upper")
    return _scored(spark, sf_dir).select(
        *SERIES,
        "forecast_month",
        low.alias("lower"),
        high.alias("upper"),
        F.round(high - low, 2).alias("width"),
    )


def _shaped(build: Callable[[SampleTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(build(SampleTables(spark, sf_dir)))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "bronze_ingest_stream": bronze_ingest_stream,
        "bronze_widened": bronze_widened,
        "bronze_redelivery": bronze_redelivery,
        "silver_incremental": lambda s, d: present(silver_incremental(s, d)),
        "sink_csv_roundtrip": sink_csv_roundtrip,
        "sink_csv_text": sink_csv_text,
        "table_inventory": inventory,
        "expect_drop": expect_drop,
        "expect_warn_report": expect_warn_report,
        "fk_orphans": fk_orphans,
        "dedup_latest": dedup_latest_events,
        "filter_slice": lambda s, d: present(filter_slice(s, d)),
        "scalar_functions": lambda s, d: present(scalar_functions(s, d)),
        "calendar_dim": calendar_dim,
        "derived_measures": lambda s, d: present(derived_measures(s, d)),
    }
    out |= {feed.silver_table: _silver(name) for name, feed in FEEDS.items()}
    out |= {
        "yoy_growth": _shaped(lambda t: gold.yoy_growth(*t.star())),
        "budget_variance": _shaped(lambda t: gold.budget_variance(*t.star())),
        "gold_cash_flow_actual": _shaped(
            lambda t: gold.gold_cash_flow_summary(*t.star(), scenario_name="Actual")
        ),
        "gold_leverage_period_end": _shaped(
            lambda t: gold.gold_leverage_metrics(
                t.fact_debt_schedule(),
                t.dim_time(),
                balance="period_end",
                bridge=t["gold_ebitda_bridge"],
            )
        ),
    }
    out |= {spec.name: _table(spec.name) for spec in GOLD_TABLES}
    out |= {name: _view(name) for name in VIEW_GRAINS}
    out |= {
        "mv_forecast_accuracy_aligned": lambda s, d: present(forecast_accuracy_aligned(s, d)),
        "metric_parity": _shaped(metrics.metric_parity),
    }
    out |= {name: _report(name) for name in REPORTS}
    out |= {name: _question(name) for name in QUESTIONS}
    out |= {
        "ml_monthly_revenue": _shaped(lambda t: _monthly(t).drop("order_backlog_value")),
        "ml_lags": _shaped(lambda t: fc.with_lags(_series(t), SERIES)),
        "ml_lags_gap_aware": _shaped(lambda t: fc.with_lags(_series(t), SERIES, True)),
        "ml_rolling": _shaped(lambda t: fc.with_rolling(_series(t), SERIES)),
        "ml_features": _shaped(_features),
        "ml_training_set": _shaped(_training),
        "ml_cv_folds": _shaped(lambda t: fc.fold_summary(_training(t))),
        "ml_train": ml_train,
        "ml_cv_metrics": ml_cv_metrics,
        "ml_feature_importance": ml_feature_importance,
        "ml_scoring_frame": _shaped(lambda t: fc.scoring_frame(_training(t), SERIES)),
        "ml_cv_shape": ml_cv_shape,
        "ml_importance_shape": ml_importance_shape,
        "ml_attribution": ml_attribution,
        "ml_attribution_shape": ml_attribution_shape,
        "ml_forecast_shape": ml_forecast_shape,
        "forecast_intervals": forecast_intervals,
        "ml_revenue_forecast": _scored,
    }
    return out | TEXT_QUERIES


def oracle_sql() -> dict[str, str]:
    from oracle.catalog import statements

    return statements() | TEXT_SQL
