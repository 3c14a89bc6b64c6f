import numpy as np
import pytest
from pyspark.sql import functions as F
from star import money

from tallyforge.plans import forecast as fc

KEYS = ("entity_id", "product_family")


def series(make, months):
    """One series with a row per (month index, revenue)."""
    rows = [("E1", "F1", m // 12, m % 12 + 1, m, money(v)) for m, v in months]
    return make(
        rows,
        "entity_id string, product_family string, fiscal_year int, fiscal_month int, month_index int, "
        "monthly_revenue decimal(18,2)",
    )


def by_month(df):
    return {r.month_index: r for r in df.collect()}


def test_lags_by_row_and_by_month(make):
    df = series(make, [(0, 10), (1, 20), (3, 40)])
    by_row = by_month(fc.with_lags(df, KEYS))
    assert by_row[3].lag_revenue_1m == 20 and by_row[0].lag_revenue_1m is None
    by_gap = by_month(fc.with_lags(df, KEYS, gap_aware=True))
    assert by_gap[3].lag_revenue_1m is None and by_gap[3].lag_revenue_2m == 20


def test_rolling_excludes_the_current_row(make):
    df = series(make, [(m, 10 * (m + 1)) for m in range(8)])
    out = by_month(fc.with_rolling(df, KEYS))
    assert out[0].rolling_mean_3m is None
    assert out[1].rolling_mean_3m == 10 and out[2].rolling_mean_3m == 15
    assert out[7].rolling_mean_3m == 60 and out[7].rolling_mean_6m == 45
    gap = by_month(fc.with_rolling(series(make, [(0, 10), (5, 50)]), KEYS, gap_aware=True))
    assert gap[5].rolling_mean_3m is None and gap[5].rolling_mean_6m == 10


def test_short_series_has_no_seasonal_lag(make):
    out = fc.with_lags(series(make, [(m, m) for m in range(12)]), KEYS)
    assert out.where("yoy_revenue_same_month IS NOT NULL").count() == 0


def test_monthly_revenue_and_leading_traits(make):
    orders = make(
        [
            ("E1", "P1", 1, money(10), True),
            ("E1", "P2", 1, money(30), False),
            ("E1", "P2", 1, money(5), None),
            ("E9", "P1", 1, money(99), True),
        ],
        "entity_id string, product_id string, time_id int, net_amount_usd decimal(18,2), backlog_flag boolean",
    )
    entity = make(
        [("E1", "North", "Asia", False), ("E9", "North", "Asia", True)],
        "entity_id string, business_unit string, region string, is_consolidated boolean",
    )
    product = make(
        [("P1", "F1", "Auto", False), ("P2", "F1", "Medical", False)],
        "product_id string, product_family string, end_market string, is_aftermarket boolean",
    )
    time = make([(1, 2025, 1, "Q1")], "time_id int, fiscal_year int, fiscal_month int, fiscal_quarter string")
    monthly = fc.monthly_order_revenue(orders, entity, product, time)
    assert {(r.end_market, r.monthly_revenue) for r in monthly.collect()} == {
        ("Auto", money(10)), ("Medical", money(35)),
    }
    row = fc.series_months(monthly).first()
    assert (row.monthly_revenue, row.order_backlog_value) == (money(45), money(10))
    assert row.end_market == "Medical" and row.period == "2025-01"


def split_by_hand(n, folds):
    """Expanding windows over n ordered periods."""
    size = n // (folds + 1)
    return [(list(range(n - (folds - k) * size)), size) for k in range(folds)]


@pytest.mark.parametrize("n", [8, 11, 17])
def test_folds(make, n):
    df = make([(100 + p, r) for p in range(n) for r in range(2)], "month_index int, r int")
    rows = fc.assign_folds(df, 3).collect()
    for k, (train, size) in enumerate(split_by_hand(n, 3), start=1):
        got = {role: sorted({r.month_index - 100 for r in rows if r.fold == k and r.role == role}) for role in ("train", "validate")}
        assert got["train"] == train
        assert got["validate"] == list(range(len(train), len(train) + size))


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(7)
    rows = []
    for unit in range(6):
        for month in range(24):
            lag = float(rng.uniform(100, 1000))
            numbers = [lag] + [float(rng.uniform(0, 10)) for _ in range(13)]
            target = 2 * lag + 50 * unit
            index = 2024 * 12 + month
            rows.append((f"E{unit}", "F1", f"{index // 12}-{index % 12 + 1:02d}", index, index // 12, index % 12 + 1, *numbers, target, f"B{unit % 3}", "R", "M", "false"))
    names = ", ".join(f"{c} double" for c in [*fc.NUMERIC_FEATURES, fc.TARGET])
    cats = ", ".join(f"{c} string" for c in fc.CATEGORICAL_FEATURES)
    df = spark.createDataFrame(
        rows,
        f"entity_id string, product_family string, period string, month_index int, fiscal_year int, fiscal_month int, {names}, {cats}",
    )
    return fc.materialise(df, "test-training")


PARAMS = fc.TreeParams(trees=8, depth=4, learning_rate=0.3, min_rows_per_leaf=2)


@pytest.fixture(scope="module")
def model(training):
    return fc.train_forecast(training, PARAMS)


def test_training_without_rows_is_named(training):
    with pytest.raises(ValueError, match="no training rows"):
        fc.train_forecast(training.limit(0), PARAMS)


def test_training_set_drops_gaps_and_bad_numbers(training):
    good = training.withColumn("fx_rate_avg", F.col("fx_rate_avg").cast("string"))
    bad = training.limit(3).withColumn("fx_rate_avg", F.lit("n/a"))
    gap = good.limit(2).withColumn("lag_revenue_6m", F.lit(None).cast("double"))
    assert fc.training_set(good.unionByName(bad).unionByName(gap)).count() == training.count()


def test_scoring_frame_calendar(training):
    frame = fc.scoring_frame(training)
    assert frame.count() == 6 * 18
    one = {r.months_ahead: r for r in frame.where("entity_id = 'E0'").collect()}
    # The latest month is December 2025.
    assert one[1].forecast_month == "2026-01" and one[12].forecast_month == "2026-12"
    assert one[13].forecast_month == "2027-01" and one[18].forecast_month == "2027-06"
    assert (one[13].fiscal_year, one[13].fiscal_month, one[13].quarter) == (2027, 1, 1.0)
    assert len({r.lag_revenue_1m for r in one.values()}) == 1


def test_scores_have_ordered_ranges_and_repeat(training, model):
    def rows(m):
        return sorted(tuple(r)[:-1] for r in fc.score_forecast(m, training).collect())

    first = rows(model)
    assert len(first) == 108 and all(r[4] <= r[3] <= r[5] for r in first)
    assert rows(fc.train_forecast(training, PARAMS)) == first
    spread = fc.residual_spread(model, training)
    fitted = model.transform(training).toPandas()
    assert spread == pytest.approx(np.std(fitted[fc.TARGET] - fitted["prediction"]))


def test_metrics_against_numpy(make):
    y, p = np.array([0.0, 10.0, 20.0, 40.0]), np.array([1.0, 8.0, 22.0, 44.0])
    df = make([(float(a), float(b)) for a, b in zip(y, p, strict=True)], f"{fc.TARGET} double, prediction double")
    row = fc.regression_metrics(df).first()
    assert row.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert row.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert row.mape == pytest.approx(np.mean(np.abs((y - p) / np.where(y == 0, 1, y))) * 100)
    assert row.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_cross_validation_has_a_mean_line(training):
    rows = fc.cross_validate(training, PARAMS).collect()
    assert [r.fold for r in rows] == [1, 2, 3, None]
    assert rows[3].rmse == pytest.approx(np.mean([r.rmse for r in rows[:3]]))


def test_importance_ranks_the_driver_first(training, model):
    rows = fc.feature_importance(model, training, sample_size=40).collect()
    assert len(rows) == 18 and rows[0].feature == "lag_revenue_1m"
    assert sum(r.split_importance for r in rows) == pytest.approx(1)
    assert {r.mean_abs_shap for r in rows if r.feature in ("region", "end_market")} == {0.0}


def test_unseen_category_still_scores(training, model):
    odd = training.limit(1).withColumn("business_unit", F.lit("never seen"))
    assert model.transform(odd).first().prediction is not None
