"""Splits and trees against a search over all cuts, growth by jobs against growth in a task, attribution against subsets."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.plans import boosting as bt

NUMBERS, CATEGORIES = ("a", "b", "c", "d"), ("k", "m")


def rows(count, seed=3):
    rng = np.random.default_rng(seed)
    data = {n: rng.integers(0, 12, count).astype(float) for n in NUMBERS}
    data |= {"k": rng.choice(["x", "y", "z", "w"], count), "m": rng.choice(["p", "q"], count)}
    wave = np.where(data["k"] == "x", 30.0, 0.0) + np.where(data["m"] == "p", data["b"], 0.0)
    data["y"] = 3.0 * data["a"] + wave + rng.normal(0, 2, count).round(2)
    return pd.DataFrame(data)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(400)).repartition(3).cache()


def train(table, params, local_rows=bt.LOCAL_ROWS, parts=None):
    parts = parts or {0: F.lit(True)}
    return bt.train_parts(table, parts, NUMBERS, CATEGORIES, "y", params, local_rows)


def score(gradient, count, params):
    return max(abs(gradient) - params.l1, 0.0) ** 2 / (count + params.l2)


def brute_split(codes, gradient, columns, categories, unit, params):
    """The best cut over every feature, from the rows themselves."""
    best = (0.0, None, None)
    for f in columns:
        present = sorted(set(codes[:, f].tolist()))
        if f in categories:
            present.sort(
                key=lambda c: gradient[codes[:, f] == c].sum() * unit
                / ((codes[:, f] == c).sum() + params.category_smoothing)
            )
        for cut in range(1, len(present)):
            left = np.isin(codes[:, f], present[:cut])
            if min(left.sum(), (~left).sum()) < params.min_rows_per_leaf:
                continue
            gain = score(gradient[left].sum() * unit, left.sum(), params)
            gain += score(gradient[~left].sum() * unit, (~left).sum(), params)
            gain -= score(gradient.sum() * unit, len(left), params)
            if gain > best[0] + 1e-9 * abs(gain):
                best = (gain, f, left)
    return best


def brute_tree(codes, target, prediction, columns, categories, unit, params):
    """Prediction of one tree, grown best leaf first."""
    gradient = np.rint((prediction - target) / unit)
    leaves = {1: np.arange(len(target))}
    for _ in range(params.leaves - 1):
        options = []
        for label, held in leaves.items():
            if label.bit_length() <= params.depth:
                gain, f, left = brute_split(codes[held], gradient[held], columns, categories, unit, params)
                if f is not None:
                    options.append((-gain, label, left))
        if not options:
            break
        _, label, left = min(options, key=lambda o: o[:2])
        held = leaves.pop(label)
        leaves |= {2 * label: held[left], 2 * label + 1: held[~left]}
    out = prediction.copy()
    for held in leaves.values():
        total = gradient[held].sum() * unit
        out[held] -= params.learning_rate * np.sign(total) * max(abs(total) - params.l1, 0) / (len(held) + params.l2)
    return out


PARAMS = bt.TreeParams(trees=6, leaves=9, depth=4, learning_rate=0.3, min_rows_per_leaf=5, l1=0.5, l2=2.0)


def test_trees_equal_a_search_over_all_cuts(table):
    model = train(table, PARAMS)[0]
    frame = rows(400)
    codes = model.binning.codes([frame[c].to_numpy() for c in model.binning.columns])
    y = frame["y"].to_numpy()
    unit = bt.gradient_unit(max(abs(y.max() - model.start), abs(y.min() - model.start)), len(y))
    expected = np.full(len(y), model.start)
    for number in range(PARAMS.trees):
        columns = bt.tree_columns(6, number, PARAMS)
        assert len(columns) == 5
        expected = brute_tree(codes, y, expected, columns, {4, 5}, unit, PARAMS)
    assert model.predict(codes) == pytest.approx(expected, abs=1e-9)
    assert all(len(t.feature) <= 2 * PARAMS.leaves - 1 for t in model.trees)


def test_category_sets_are_the_best_of_all_subsets():
    rng = np.random.default_rng(1)
    params = bt.TreeParams(min_rows_per_leaf=1, l1=0.0, l2=0.0, category_smoothing=0.0)
    for _ in range(20):
        counts, sums = np.zeros(bt.BINS, np.int64), np.zeros(bt.BINS, np.int64)
        counts[:6], sums[:6] = rng.integers(1, 9, 6), rng.integers(-40, 40, 6)
        best = 0.0
        for size in range(1, 6):
            for chosen in combinations(range(6), size):
                s, c = sums[list(chosen)].sum(), counts[list(chosen)].sum()
                gain = s**2 / c + (sums.sum() - s) ** 2 / (counts.sum() - c) - sums.sum() ** 2 / counts.sum()
                best = max(best, gain)
        found = bt.best_splits(sums[None], counts[None], [0], [0], 1.0, params)
        assert (found.gain if found else 0.0) == pytest.approx(best)


@pytest.mark.parametrize("leaves, depth", [(9, 4), (5, 6)])
def test_jobs_grow_the_trees_of_a_task(table, monkeypatch, leaves, depth):
    monkeypatch.setattr(bt, "TREES_BETWEEN", 2)
    params = bt.TreeParams(trees=5, leaves=leaves, depth=depth, learning_rate=0.3, min_rows_per_leaf=5)
    here, by_jobs = train(table, params)[0], train(table.repartition(5), params, local_rows=0)[0]
    assert here.trees == by_jobs.trees and here.binning == by_jobs.binning


def test_parts_are_models_of_their_rows(table):
    params = bt.TreeParams(trees=3, min_rows_per_leaf=5)
    both = train(table, params, parts={0: F.lit(True), 1: F.col("a") < 6, 2: F.col("a") > 99})
    assert set(both) == {0, 1}
    assert both[1].trees == train(table.where("a < 6"), params)[0].trees
    assert both[0].trees == train(table, params)[0].trees


def conditional(tree, codes, known, node=0):
    """Expected value of a tree when some features are known."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        return conditional(tree, codes, known, left if codes[f] in tree.left_codes[node] else right)
    return sum(conditional(tree, codes, known, c) * tree.rows[c] for c in (left, right)) / tree.rows[node]


def test_attribution_equals_all_subsets_and_adds_up(table, spark):
    model = train(table, bt.TreeParams(trees=12, min_rows_per_leaf=4, learning_rate=0.3))[0]
    frame = rows(400)
    codes = model.binning.codes([frame[c].to_numpy() for c in model.binning.columns])
    values, base = bt.attributions(model, codes)
    assert values.sum(axis=1) + base == pytest.approx(model.predict(codes), abs=1e-9)
    for row in range(0, 400, 57):
        worth = {
            s: sum(conditional(t, codes[row].tolist(), set(s)) for t in model.trees)
            for size in range(7) for s in combinations(range(6), size)
        }
        for f in range(6):
            others = [s for s in worth if f not in s]
            expected = sum(
                factorial(len(s)) * factorial(5 - len(s)) / factorial(6)
                * (worth[tuple(sorted({*s, f}))] - worth[s]) for s in others
            )
            assert values[row, f] == pytest.approx(expected, abs=1e-9)
    assert base - model.start == pytest.approx(worth[()])
    explained = bt.explain(model, table, ["y"])
    assert explained.count() == 400
    r = explained.first()
    assert sum(r.attribution) + r.base == pytest.approx(r.prediction)


def test_saved_models_predict_alike(table, spark, tmp_path):
    model = train(table, bt.TreeParams(trees=3, min_rows_per_leaf=5))[0]
    model.save(spark, str(tmp_path / "model"))
    loaded = bt.BoostedTrees.load(spark, str(tmp_path / "model"))
    assert loaded.trees == model.trees and loaded.binning == model.binning and loaded.params == model.params
    odd = table.limit(3).withColumn("k", F.lit("new")).withColumn("a", F.lit(1e9))
    assert [r.prediction for r in loaded.transform(odd).collect()] == [r.prediction for r in model.transform(odd).collect()]
    assert sum(model.split_shares()) == pytest.approx(1)


def test_constant_targets_and_many_labels(spark):
    flat = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, "x", None, 5.0)] * 30, "a double, b double, c double, d double, k string, m string, y double")
    model = train(flat, bt.TreeParams(trees=2))[0]
    assert model.transform(flat).first().prediction == 5.0 and sum(model.split_shares()) == 0
    many = flat.limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(300)).cast("array<string>")))
    with pytest.raises(ValueError, match="labels"):
        train(many, bt.TreeParams(trees=2))


def test_errors_are_not_above_spark_ml_trees_of_equal_size(spark):
    """Like settings on held-out rows: 40 trees, depth 5, 32 leaves."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    df = spark.createDataFrame(rows(3000, seed=8))
    fit, held = df.limit(2000).cache(), spark.createDataFrame(rows(1000, seed=9)).cache()
    model = train(fit, bt.TreeParams(trees=40, leaves=32, depth=5, learning_rate=0.2, column_share=1.0))[0]
    indexed = [f"{c}_index" for c in CATEGORIES]
    peer = Pipeline(stages=[
        StringIndexer(inputCols=list(CATEGORIES), outputCols=indexed),
        VectorAssembler(inputCols=[*NUMBERS, *indexed], outputCol="features"),
        GBTRegressor(labelCol="y", maxIter=40, maxDepth=5, stepSize=0.2, minInstancesPerNode=20, seed=1),
    ]).fit(fit)
    error = lambda out: out.selectExpr("sqrt(avg((y - prediction) * (y - prediction)))").first()[0]
    assert error(model.transform(held)) <= error(peer.transform(held)) * 1.05
