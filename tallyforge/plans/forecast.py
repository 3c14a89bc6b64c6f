"""Revenue forecast: features, folds, training, scoring and attribution.

Everything stays distributed. Only scalars (the residual spread, label counts)
and the fitted model reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.calendar import (
    index_month,
    index_year,
    month_index,
    month_quarter,
    period_key,
    quarter_number,
)
from tallyforge.operators.dedup import dedup_latest
from tallyforge.operators.ratios import exact_mean
from tallyforge.plans import boosting
from tallyforge.plans.boosting import BoostedTrees, TreeParams
from tallyforge.session import scratch_path

# Feature names, horizon and the normal quantile of a 95 % range.
LAGS = [1, 2, 3, 4, 5, 6]
SEASON = 12
NUMERIC_FEATURES = [
    "lag_revenue_1m",
    "lag_revenue_2m",
    "lag_revenue_3m",
    "lag_revenue_4m",
    "lag_revenue_5m",
    "lag_revenue_6m",
    "rolling_mean_3m",
    "rolling_mean_6m",
    "yoy_revenue_same_month",
    "order_backlog_value",
    "month_of_year",
    "quarter",
    "utilization_pct",
    "fx_rate_avg",
]
CATEGORICAL_FEATURES = ["business_unit", "region", "end_market", "is_aftermarket"]
FEATURES = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
TARGET = "monthly_revenue"
SERIES_KEYS = ("entity_id", "product_family")
HORIZON = 18
NORMAL_95 = 1.96


# Features ---------------------------------------------------------------------


def monthly_order_revenue(
    orders: DataFrame,
    entity: DataFrame,
    product: DataFrame,
    time: DataFrame,
    series_keys: Sequence[str] = SERIES_KEYS,
) -> DataFrame:
    """Order revenue and open backlog by series, categorical traits and month.

    Consolidating entities are left out. The backlog is summed in the same pass
    over the orders as the revenue.
    """
    leaves = entity.where(~F.col("is_consolidated"))
    rows = (
        orders.select("entity_id", "product_id", "time_id", "net_amount_usd", "backlog_flag")
        .join(leaves.select("entity_id", "business_unit", "region"), "entity_id")
        .join(
            product.select("product_id", "product_family", "end_market", "is_aftermarket"),
            "product_id",
        )
        .join(time.select("time_id", "fiscal_year", "fiscal_month", "fiscal_quarter"), "time_id")
    )
    grain = [*series_keys, *CATEGORICAL_FEATURES, "fiscal_year", "fiscal_month", "fiscal_quarter"]
    open_amount = F.when(F.col("backlog_flag"), F.col("net_amount_usd"))
    return rows.groupBy(*dict.fromkeys(grain)).agg(
        F.sum("net_amount_usd").alias(TARGET),
        F.coalesce(F.sum(open_amount), F.lit(0)).cast("decimal(28,2)").alias("order_backlog_value"),
    )


def series_months(monthly: DataFrame, series_keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """One row per series and month.

    Traits that are not part of the series key come from the month's largest
    part of the series, so all categorical features exist at every grain.
    """
    keys = [*series_keys, "fiscal_year", "fiscal_month", "fiscal_quarter"]
    traits = [c for c in CATEGORICAL_FEATURES if c not in series_keys]
    aggregates = [
        F.sum(TARGET).cast("decimal(28,2)").alias(TARGET),
        F.sum("order_backlog_value").cast("decimal(28,2)").alias("order_backlog_value"),
    ]
    if traits:
        aggregates.append(F.max(F.struct(TARGET, *traits)).alias("_lead"))
    out = monthly.groupBy(*keys).agg(*aggregates)
    lead = [F.col(f"_lead.{c}").alias(c) for c in traits]
    return out.select(
        *keys,
        TARGET,
        "order_backlog_value",
        *lead,
        period_key(F.col("fiscal_year"), F.col("fiscal_month")).alias("period"),
        month_index(F.col("fiscal_year"), F.col("fiscal_month")).alias("month_index"),
    )


def _series_window(series_keys: Sequence[str]):
    # A series has one row per calendar month, so its length is bounded.
    return Window.partitionBy(*series_keys).orderBy("month_index")


def _lag(months: int, series_keys: Sequence[str], gap_aware: bool) -> Column:
    window = _series_window(series_keys)
    if gap_aware:
        return F.sum(TARGET).over(window.rangeBetween(-months, -months))
    return F.lag(TARGET, months).over(window)


def with_lags(
    series: DataFrame, series_keys: Sequence[str] = SERIES_KEYS, gap_aware: bool = False
) -> DataFrame:
    """Revenue of earlier months; by row, or by calendar month if ``gap_aware``."""
    columns = {
        f"lag_revenue_{k}m": _lag(k, series_keys, gap_aware).cast("double") for k in LAGS
    }
    columns["yoy_revenue_same_month"] = _lag(SEASON, series_keys, gap_aware).cast("double")
    return series.withColumns(columns)


def with_rolling(
    series: DataFrame, series_keys: Sequence[str] = SERIES_KEYS, gap_aware: bool = False
) -> DataFrame:
    """Mean of up to three and six earlier months, NULL when there is none."""
    window = _series_window(series_keys)
    columns = {}
    for size in (3, 6):
        frame = window.rangeBetween(-size, -1) if gap_aware else window.rowsBetween(-size, -1)
        total = F.sum(TARGET).over(frame).cast("double")
        columns[f"rolling_mean_{size}m"] = F.try_divide(total, F.count(TARGET).over(frame))
    return series.withColumns(columns)


def utilization_by_quarter(plants: DataFrame) -> DataFrame:
    return plants.groupBy("fiscal_year", "fiscal_quarter").agg(
        F.avg("utilization_pct").cast("double").alias("utilization_pct")
    )


def rates_by_month(fx: DataFrame, time: DataFrame) -> DataFrame:
    dates = time.select("time_id", "fiscal_year", "fiscal_month")
    return (
        fx.select("time_id", "avg_rate")
        .join(dates, "time_id")
        .groupBy("fiscal_year", "fiscal_month")
        .agg(exact_mean(F.col("avg_rate")).alias("fx_rate_avg"))
    )


def forecast_features(
    orders: DataFrame,
    entity: DataFrame,
    product: DataFrame,
    time: DataFrame,
    plants: DataFrame,
    fx: DataFrame,
    series_keys: Sequence[str] = SERIES_KEYS,
    gap_aware: bool = False,
) -> DataFrame:
    """All features and the target, one row per series and month."""
    monthly = monthly_order_revenue(orders, entity, product, time, series_keys)
    series = series_months(monthly, series_keys)
    series = with_rolling(with_lags(series, series_keys, gap_aware), series_keys, gap_aware)
    return (
        series.withColumn("month_of_year", F.col("fiscal_month"))
        .withColumn("quarter", quarter_number(F.col("fiscal_quarter")))
        .join(utilization_by_quarter(plants), ["fiscal_year", "fiscal_quarter"], "left")
        .join(rates_by_month(fx, time), ["fiscal_year", "fiscal_month"], "left")
        .fillna(0, ["order_backlog_value"])
    )


def training_set(features: DataFrame, series_keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Numeric features as doubles, categories as text, no row with a gap."""
    kept = [c for c in series_keys if c not in CATEGORICAL_FEATURES]
    numbers = [F.col(c).try_cast("double").alias(c) for c in [*NUMERIC_FEATURES, TARGET]]
    categories = [F.col(c).cast("string").alias(c) for c in CATEGORICAL_FEATURES]
    return features.select(
        *kept, "period", "month_index", "fiscal_year", "fiscal_month", *numbers, *categories
    ).dropna(subset=[*NUMERIC_FEATURES, TARGET])


# Folds ------------------------------------------------------------------------


def fold_periods(df: DataFrame, folds: int = 3, period: str = "month_index") -> DataFrame:
    """Validation periods of each fold: equal blocks at the end of the time line.

    With ``n`` distinct periods a block has ``n div (folds + 1)`` of them; a fold
    trains on everything before its block.
    """
    # Distinct months of a calendar: a short list, whatever the size of ``df``.
    periods = df.select(F.col(period).alias("p")).distinct()
    place = F.row_number().over(Window.orderBy("p")) - 1
    placed = periods.select("p", place.alias("at"), F.count("p").over(Window.partitionBy()).alias("n"))
    block = F.floor(F.col("n") / (folds + 1))
    fold = F.explode(F.sequence(F.lit(1), F.lit(folds)))
    return (
        placed.select("p", "at", "n", block.alias("block"), fold.alias("fold"))
        .withColumn("first", F.col("n") - (folds + 1 - F.col("fold")) * F.col("block"))
        .where((F.col("at") >= F.col("first")) & (F.col("at") < F.col("first") + F.col("block")))
        .groupBy("fold")
        .agg(F.min("p").alias("first_period"), F.max("p").alias("last_period"))
    )


def assign_folds(df: DataFrame, folds: int = 3, period: str = "month_index") -> DataFrame:
    """Every row once per fold that uses it, with its role there.

    The fold list has ``folds`` rows, so each input row yields at most that many.
    """
    bounds = fold_periods(df, folds, period)
    spans = bounds.agg(F.collect_list(F.struct("fold", "first_period", "last_period"))).scalar()
    at = F.col(period)
    role = F.when(at < F.col("_fold.first_period"), "train").otherwise("validate")
    return (
        df.select("*", F.explode(spans).alias("_fold"))
        .where(at <= F.col("_fold.last_period"))
        .select(*df.columns, F.col("_fold.fold").alias("fold"), role.alias("role"))
    )


def fold_summary(df: DataFrame, folds: int = 3) -> DataFrame:
    """Periods and row counts per fold and role."""
    return (
        assign_folds(df, folds)
        .groupBy("fold", "role")
        .agg(
            F.min("period").alias("first_period"),
            F.max("period").alias("last_period"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


# Training -----------------------------------------------------------------------


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def train_parts(training: DataFrame, parts: dict[int, Column], params: TreeParams | None = None) -> dict[int, BoostedTrees]:
    """A model for each named part of ``training``, fitted side by side; hand in a materialised table.

    A table without rows is an error.
    """
    if training.isEmpty():
        raise ValueError("no training rows: no series is long enough for the lags at these series keys")
    return boosting.train_parts(training, parts, NUMERIC_FEATURES, CATEGORICAL_FEATURES, TARGET, params or TreeParams())


def train_forecast(training: DataFrame, params: TreeParams | None = None) -> BoostedTrees:
    """Fit bins, labels and boosted trees on ``training`` alone."""
    return train_parts(training, {0: F.lit(True)}, params)[0]


def train_with_folds(training: DataFrame, params: TreeParams | None = None, folds: int = 3) -> dict[int, BoostedTrees]:
    """The model of all rows under 0, and under its number that of each fold."""
    spans = fold_periods(training, folds).collect()
    before = {span.fold: F.col("month_index") < span.first_period for span in spans}
    return train_parts(training, {0: F.lit(True)} | before, params)


def regression_metrics(predictions: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, MAPE (zero actuals divide by one) and R² in one pass."""
    y, error = F.col(TARGET), F.col(TARGET) - F.col("prediction")
    divisor = F.when(y == 0, F.lit(1.0)).otherwise(y)
    squares = F.sum(error * error)
    return predictions.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(error / divisor)) * 100).alias("mape"),
        (1 - F.try_divide(squares, F.var_pop(y) * F.count(y))).alias("r2"),
    )


def cross_validate(
    training: DataFrame,
    params: TreeParams | None = None,
    folds: int = 3,
    models: dict[int, BoostedTrees] | None = None,
) -> DataFrame:
    """Metrics per fold, and their means in the row with a NULL fold.

    ``models`` of ``train_with_folds`` are used where given.
    """
    # One row for each fold; the months filter the stored rows directly.
    spans = fold_periods(training, folds).orderBy("fold").collect()
    if not spans:
        raise ValueError("no folds: the training rows span too few months")
    models = models or train_with_folds(training, params, folds)
    scored, month = [], F.col("month_index")
    for span in spans:
        rows = training.where(month.between(span.first_period, span.last_period))
        predictions = models[span.fold].transform(rows)
        scored.append(predictions.select(F.lit(span.fold).alias("fold"), TARGET, "prediction"))
    per_fold = regression_metrics(reduce(DataFrame.unionByName, scored), ["fold"])
    # Grouping sets over the handful of fold rows give the mean line as well.
    return (
        per_fold.rollup("fold")
        .agg(
            F.sum("row_count").alias("row_count"),
            *[F.avg(m).alias(m) for m in ("rmse", "mae", "mape", "r2")],
        )
        .orderBy(F.col("fold").asc_nulls_last())
    )


# Attribution --------------------------------------------------------------------


def sample_rows(df: DataFrame, size: int, seed: int) -> DataFrame:
    """At most ``size`` rows in hash order, the same ones on every run."""
    order = F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns])
    return df.withColumn("_order", order).orderBy("_order").limit(size).drop("_order")


def attribution(model: BoostedTrees, rows: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """``kept`` columns, the exact Shapley value of each feature, base and prediction of every row."""
    return boosting.explain(model, rows, kept)


def feature_importance(
    model: BoostedTrees, training: DataFrame, sample_size: int | None = None, seed: int = 42
) -> DataFrame:
    """Mean absolute Shapley value per feature, beside its share in the gain of all splits.

    Every row is explained; ``sample_size`` explains that many, in hash order.
    """
    chosen = training if sample_size is None else sample_rows(training, sample_size, seed)
    values = attribution(model, chosen).select(F.posexplode("attribution").alias("j", "shap"))
    shares = list(enumerate(zip(FEATURES, model.split_shares(), strict=True)))
    split_gain = training.sparkSession.createDataFrame(
        [(number, name, share) for number, (name, share) in shares], "j int, feature string, split_importance double"
    )
    return (
        values.groupBy("j")
        .agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
        .join(split_gain, "j")
        .select("feature", "mean_abs_shap", "split_importance")
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


# Scoring ------------------------------------------------------------------------


def scoring_frame(
    training: DataFrame, series_keys: Sequence[str] = SERIES_KEYS, horizon: int = HORIZON
) -> DataFrame:
    """The latest row of each series, once per future month.

    Calendar features move with the month; lag features stay as they are in the
    latest row.
    """
    latest = dedup_latest(training, list(series_keys), ["month_index"])
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    frame = latest.select("*", ahead.alias("months_ahead"))
    target = F.col("month_index") + F.col("months_ahead")
    frame = frame.withColumn("month_index", target)
    year, month = index_year(F.col("month_index")), index_month(F.col("month_index"))
    return frame.withColumns(
        {
            "fiscal_year": year,
            "fiscal_month": month,
            "month_of_year": month.cast("double"),
            "quarter": month_quarter(month).cast("double"),
            "forecast_month": period_key(year, month),
        }
    )


def residual_spread(model: BoostedTrees, training: DataFrame) -> float:
    """Population standard deviation of the in-sample residuals."""
    fitted = model.transform(training)
    return fitted.agg(F.stddev_pop(F.col(TARGET) - F.col("prediction"))).first()[0] or 0.0


def score_forecast(
    model: BoostedTrees,
    training: DataFrame,
    series_keys: Sequence[str] = SERIES_KEYS,
    horizon: int = HORIZON,
) -> DataFrame:
    """Predictions with a 95 % range for every series and future month."""
    margin = NORMAL_95 * residual_spread(model, training)
    scored = model.transform(scoring_frame(training, series_keys, horizon))
    value = F.col("prediction")
    return scored.select(
        *series_keys,
        "forecast_month",
        F.round(value, 2).alias("predicted_revenue"),
        F.round(value - margin, 2).alias("prediction_interval_lower"),
        F.round(value + margin, 2).alias("prediction_interval_upper"),
        F.current_timestamp().alias("scored_at"),
    )
