"""Leaf-wise boosted trees over binned columns, and exact attribution of their predictions.

Columns are binned once and stored: a byte for each feature of a row. A tree grows best leaf first, by the gain that a
split of its histogram of gradients has under L1 and L2 penalties, with categories split into sets along their mean
gradient. Gradients are rounded to a unit that makes every sum exact, so a tree doesn't depend on how rows are dealt.

Histograms of all leaves of a level come from one job: Arrow batches are summed within each task, the tasks' histograms
by leaf and feature, and each such group returns its best split. Leaves beyond the limit are dropped by replaying the
queue of the best leaf first over the splits found. A training set of at most ``LOCAL_ROWS`` rows, which fits a task many
times over, is grown by one task with the same split search and queue, and several sets at once by several tasks.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from math import factorial, frexp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import scratch_path

BINS = 256
LOCAL_ROWS = 1 << 18
PART_TASKS = 64
# Trees between two writes of the predictions so far.
TREES_BETWEEN = 20
# Rows that are explained together.
EXPLAINED_ROWS = 1024


@dataclass(frozen=True)
class TreeParams:
    """Boosting settings.

    Rows are not sampled: the usual share of 0.8 takes effect only with a sampling frequency, which is not set.
    """

    trees: int = 500
    leaves: int = 63
    depth: int = 8
    learning_rate: float = 0.05
    min_rows_per_leaf: int = 20
    column_share: float = 0.8
    l1: float = 0.1
    l2: float = 0.1
    category_smoothing: float = 10.0
    seed: int = 42


@dataclass(frozen=True)
class Binning:
    """Upper bounds of the bins of each number, and labels of each category; other labels have one more code."""

    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    bounds: tuple[tuple[float, ...], ...]
    labels: tuple[tuple[str, ...], ...]

    @property
    def columns(self) -> list[str]:
        return [*self.numbers, *self.categories]

    def codes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """A byte for each row and feature; a number that is not one falls into the last bin."""
        out = np.empty((len(columns[0]), len(columns)), np.uint8)
        for k, bounds in enumerate(self.bounds):
            out[:, k] = np.searchsorted(np.array(bounds), columns[k].astype(float), side="left")
        for k, labels in enumerate(self.labels, len(self.bounds)):
            values = np.array(columns[k], dtype=object)
            known = dict(zip(labels, range(len(labels)), strict=True))
            out[:, k] = [known.get(v, len(labels)) for v in values]
        return out


# Splits -------------------------------------------------------------------------


@dataclass(frozen=True)
class Split:
    """Codes of a feature that go left, with gain and what goes left: gradients in units, and rows."""

    gain: float
    feature: int
    left: tuple[int, ...]
    gradient: int
    rows: int


def _score(gradient: np.ndarray, rows: np.ndarray, params: TreeParams) -> np.ndarray:
    # Without penalty, a side without rows is not allowed anyway.
    return np.maximum(np.abs(gradient) - params.l1, 0.0) ** 2 / np.maximum(rows + params.l2, 1e-300)


def best_splits(
    sums: np.ndarray, counts: np.ndarray, features: Sequence[int], categories: Sequence[int], unit: float, params: TreeParams
) -> Split | None:
    """The split with the largest positive gain of the histograms of some features, the first of equals.

    Rows of ``sums`` and ``counts`` are features in ascending order. Numbers are cut between two bins. The codes of the
    features in ``categories`` are first ordered by mean gradient, smoothed, those without rows last.
    """
    category = np.isin(features, categories)
    order = None
    if category.any():
        order = np.tile(np.arange(BINS), (len(features), 1))
        rows = counts[category]
        mean = np.where(rows > 0, sums[category] * unit / np.maximum(rows + params.category_smoothing, 1e-300), np.inf)
        order[category] = np.argsort(mean, axis=1, kind="stable")
        sums, counts = np.take_along_axis(sums, order, 1), np.take_along_axis(counts, order, 1)
    left, held = np.cumsum(sums, axis=1), np.cumsum(counts, axis=1)
    total, count = int(left[0, -1]), int(held[0, -1])
    least = max(params.min_rows_per_leaf, 1)
    allowed = (held >= least) & (count - held >= least)
    if not allowed.any():
        return None
    parent = _score(np.array(total * unit), np.array(count), params)
    gain = _score(left * unit, held, params) + _score((total - left) * unit, count - held, params) - parent
    gain = np.where(allowed, gain, -1.0)
    at = int(np.argmax(gain))
    row, cut = divmod(at, BINS)
    if gain[row, cut] <= 0:
        return None
    chosen = np.arange(cut + 1) if order is None else order[row, : cut + 1]
    return Split(float(gain[row, cut]), int(features[row]), tuple(map(int, chosen)), int(left[row, cut]), int(held[row, cut]))


def better(one: Split | None, other: Split | None) -> Split | None:
    """The split of larger gain; of equals, that of the earlier feature."""
    if one is None or other is None:
        return one or other
    return max(one, other, key=lambda s: (s.gain, -s.feature))


@dataclass
class Tree:
    """Nodes in order of their label: the root has label 1, the children of ``n`` have ``2 n`` and ``2 n + 1``."""

    feature: list[int] = field(default_factory=list)
    left_codes: list[list[int]] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)


def choose(splits: dict[int, Split], leaves: int) -> list[int]:
    """Labels that are split when the leaf with the best gain is split first, the least label of equals."""
    queue = [(-splits[1].gain, 1)] if 1 in splits else []
    chosen: list[int] = []
    while queue and len(chosen) < leaves - 1:
        _, label = heapq.heappop(queue)
        chosen.append(label)
        for child in (2 * label, 2 * label + 1):
            if child in splits:
                heapq.heappush(queue, (-splits[child].gain, child))
    return chosen


def make_tree(splits: dict[int, Split], chosen: list[int], total: tuple[int, int], unit: float, params: TreeParams) -> Tree:
    """The tree of the chosen splits; ``total`` holds gradient and rows of the root."""
    held = {1: total}
    for label in sorted(chosen):
        split, (gradient, rows) = splits[label], held[label]
        held[2 * label] = (split.gradient, split.rows)
        held[2 * label + 1] = (gradient - split.gradient, rows - split.rows)
    place = {label: k for k, label in enumerate(sorted(held))}
    tree, inner = Tree(), set(chosen)
    for label in sorted(held):
        gradient, rows = held[label][0] * unit, held[label][1]
        split = splits[label] if label in inner else None
        tree.feature.append(split.feature if split else -1)
        tree.left_codes.append(list(split.left) if split else [])
        tree.left.append(place[2 * label] if split else -1)
        tree.right.append(place[2 * label + 1] if split else -1)
        shrunk = np.sign(gradient) * max(abs(gradient) - params.l1, 0.0)
        tree.value.append(0.0 if split else float(-params.learning_rate * shrunk / (rows + params.l2)))
        tree.rows.append(rows)
        tree.gain.append(split.gain if split else 0.0)
    return tree


class Walk:
    """A tree as arrays, to send rows down."""

    def __init__(self, tree: Tree) -> None:
        self.feature = np.array(tree.feature)
        self.left, self.right = np.array(tree.left), np.array(tree.right)
        self.value = np.array(tree.value)
        self.goes_left = np.zeros((len(tree.feature), BINS), bool)
        for node, codes in enumerate(tree.left_codes):
            self.goes_left[node, codes] = True

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return node
            if not inner.all():
                moving = np.flatnonzero(inner)
                at, f = node[moving], feature[moving]
                node[moving] = np.where(self.goes_left[at, codes[moving, f]], self.left[at], self.right[at])
            else:
                node = np.where(self.goes_left[node, codes[rows, feature]], self.left[node], self.right[node])

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(codes)]


def tree_columns(features: int, tree: int, params: TreeParams) -> list[int]:
    """The features that a tree may use."""
    count = max(1, round(features * params.column_share))
    drawn = np.random.default_rng([params.seed, tree]).permutation(features)[:count]
    return sorted(map(int, drawn))


def gradient_unit(largest: float, rows: int) -> float:
    """A power of two that leaves sums of ``rows`` gradients of about ``largest`` exact."""
    bits = min(30, 51 - rows.bit_length())
    return 2.0 ** (frexp(largest or 1.0)[1] - bits)


# Growth in one task -------------------------------------------------------------


def grow_locally(
    codes: np.ndarray, target: np.ndarray, start: float, unit: float, categories: int, params: TreeParams
) -> Iterator[Tree]:
    """All trees over rows held in memory; the last ``categories`` features are categories."""
    features = codes.shape[1]
    kinds = range(features - categories, features)
    prediction = np.full(len(target), start)
    for number in range(params.trees):
        columns = tree_columns(features, number, params)
        gradient = np.rint((prediction - target) / unit)

        # Codes of the tree's features, each in a range of its own.
        flat = codes[:, columns] + (BINS * np.arange(len(columns), dtype=np.int32))

        def histogram(rows: np.ndarray, gradient=gradient, flat=flat):
            picked = flat[rows].ravel()
            weights = np.repeat(gradient[rows], flat.shape[1])
            size = flat.shape[1] * BINS
            return (
                np.bincount(picked, weights, size).astype(np.int64).reshape(-1, BINS),
                np.bincount(picked, minlength=size).reshape(-1, BINS),
            )

        everything = np.arange(len(target))
        held = {1: (everything, *histogram(everything))}
        total = (int(gradient.sum()), len(target))
        splits: dict[int, Split] = {}
        queue: list[tuple[float, int]] = []

        def offer(label: int, columns=columns) -> None:
            rows, sums, counts = held[label]
            split = None
            if label.bit_length() <= params.depth and len(rows) > 1:
                split = best_splits(sums, counts, columns, kinds, unit, params)
            if split:
                splits[label] = split
                heapq.heappush(queue, (-split.gain, label))

        offer(1)
        chosen: list[int] = []
        while queue and len(chosen) < params.leaves - 1:
            _, label = heapq.heappop(queue)
            chosen.append(label)
            rows, sums, counts = held.pop(label)
            split = splits[label]
            goes = np.zeros(BINS, bool)
            goes[list(split.left)] = True
            side = goes[codes[rows, split.feature]]
            parts = {2 * label: rows[side], 2 * label + 1: rows[~side]}
            small, large = sorted(parts, key=lambda child: len(parts[child]))
            found = histogram(parts[small])
            held[small] = (parts[small], *found)
            held[large] = (parts[large], sums - found[0], counts - found[1])
            offer(2 * label)
            offer(2 * label + 1)
        tree = make_tree(splits, chosen, total, unit, params)
        place = {label: k for k, label in enumerate(sorted([*held, *chosen]))}
        for label, (rows, _, _) in held.items():
            prediction[rows] += tree.value[place[label]]
        yield tree


# Growth by jobs -----------------------------------------------------------------


def _code_matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _level_histograms(
    batches: Iterator[pa.RecordBatch], later: list[Tree], splits: dict[int, Split], labels: list[int], columns: list[int], unit: float
) -> Iterator[pa.RecordBatch]:
    """Gradients and rows by code of the level's leaves, summed over a task: one row for each leaf and feature."""
    walks = [Walk(tree) for tree in later]
    place = np.full(max(labels) + 1, -1)
    place[labels] = np.arange(len(labels))
    shape = (len(labels), len(columns), BINS)
    sums, counts = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    for batch in batches:
        codes = _code_matrix(batch.column("codes"))
        predicted = np.asarray(batch.column("prediction")).copy()
        for walk in walks:
            predicted += walk.predict(codes)
        gradient = np.rint((predicted - np.asarray(batch.column("target"))) / unit)
        label = np.ones(len(codes), np.int64)
        for parent in sorted(splits):
            goes = np.zeros(BINS, bool)
            goes[list(splits[parent].left)] = True
            here = np.flatnonzero(label == parent)
            label[here] = 2 * parent + ~goes[codes[here, splits[parent].feature]]
        leaf = np.where(label < len(place), place[np.minimum(label, len(place) - 1)], -1)
        rows = np.flatnonzero(leaf >= 0)
        if not len(rows):
            continue
        for k, column in enumerate(columns):
            at = leaf[rows] * BINS + codes[rows, column]
            size = len(labels) * BINS
            sums[:, k] += np.bincount(at, gradient[rows], size).astype(np.int64).reshape(len(labels), BINS)
            counts[:, k] += np.bincount(at, minlength=size).reshape(len(labels), BINS)
    found = [(n, k) for n in range(len(labels)) for k in range(len(columns)) if counts[n, k].any()]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([labels[n] for n, _ in found], pa.int64()),
            pa.array([columns[k] for _, k in found], pa.int32()),
            pa.array([sums[n, k].tobytes() for n, k in found], pa.binary()),
            pa.array([counts[n, k].tobytes() for n, k in found], pa.binary()),
        ],
        ["label", "feature", "sums", "counts"],
    )


_SPLIT_SCHEMA = "label long, feature int, gain double, codes binary, gradient long, rows long, total long, held long"


def _level_splits(table: pa.Table, features: int, categories: int, unit: float, params: TreeParams) -> pa.Table:
    """The best split of one leaf and feature from the tasks' histograms, and what the leaf holds."""
    label, feature = table.column("label")[0].as_py(), table.column("feature")[0].as_py()
    sums, counts = (
        np.sum([np.frombuffer(v.as_py(), np.int64) for v in table.column(c)], axis=0) for c in ("sums", "counts")
    )
    kinds = range(features - categories, features)
    split = best_splits(sums[None], counts[None], [feature], kinds, unit, params)
    row = [label, feature]
    row += [split.gain, bytes(split.left), split.gradient, split.rows] if split else [None] * 4
    row += [int(sums.sum()), int(counts.sum())]
    kinds = [pa.int64(), pa.int32(), pa.float64(), pa.binary(), *[pa.int64()] * 4]
    names = ["label", "feature", "gain", "codes", "gradient", "rows", "total", "held"]
    return pa.table([pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)], names=names)


def _advanced(batches: Iterator[pa.RecordBatch], trees: list[Tree]) -> Iterator[pa.RecordBatch]:
    walks = [Walk(tree) for tree in trees]
    for batch in batches:
        codes = _code_matrix(batch.column("codes"))
        predicted = np.asarray(batch.column("prediction")).copy()
        for walk in walks:
            predicted += walk.predict(codes)
        yield pa.RecordBatch.from_arrays(
            [batch.column("codes"), batch.column("target"), pa.array(predicted)], ["codes", "target", "prediction"]
        )


def grow_by_jobs(
    rows: DataFrame, start: float, unit: float, features: int, categories: int, params: TreeParams
) -> list[Tree]:
    """All trees over a stored table of codes and target; a job for each level of a tree.

    Only splits reach the driver, at most one for each leaf of a level and feature. Predictions so far are stored every
    ``TREES_BETWEEN`` trees, so a lost task repeats no more than those.
    """
    state = rows.select("codes", "target", F.lit(start).alias("prediction"))
    trees: list[Tree] = []
    later: list[Tree] = []
    for number in range(params.trees):
        columns = tree_columns(features, number, params)
        splits: dict[int, Split] = {}
        labels, total = [1], (0, 0)
        for _ in range(params.depth):
            partial = state.mapInArrow(
                lambda batches, at=(list(later), dict(splits), labels, columns): _level_histograms(batches, *at, unit),
                "label long, feature int, sums binary, counts binary",
            )
            found = partial.groupBy("label", "feature").applyInArrow(
                lambda table: _level_splits(table, features, categories, unit, params), _SPLIT_SCHEMA
            )
            level: dict[int, Split] = {}
            for r in found.collect():
                if labels == [1]:
                    total = (r.total, r.held)
                if r.gain is not None:
                    split = Split(r.gain, r.feature, tuple(bytes(r.codes)), r.gradient, r.rows)
                    level[r.label] = better(level.get(r.label), split)
            splits |= level
            labels = sorted(child for label in level for child in (2 * label, 2 * label + 1))
            if not labels:
                break
        tree = make_tree(splits, choose(splits, params.leaves), total, unit, params)
        trees.append(tree)
        later.append(tree)
        if len(later) == TREES_BETWEEN and number + 1 < params.trees:
            path = scratch_path(rows.sparkSession, "boosting-state")
            moved = state.mapInArrow(lambda batches, at=list(later): _advanced(batches, at), state.schema)
            moved.write.parquet(path)
            state, later = rows.sparkSession.read.schema(state.schema).parquet(path), []
    return trees


# Model --------------------------------------------------------------------------


@dataclass
class BoostedTrees:
    """A fitted model."""

    params: TreeParams
    binning: Binning
    start: float
    trees: list[Tree]

    def predict(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), self.start)
        for walk in self.walks():
            out += walk.predict(codes)
        return out

    def walks(self) -> list[Walk]:
        if not hasattr(self, "_walks"):
            self._walks = [Walk(tree) for tree in self.trees]
        return self._walks

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_walks"}

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the prediction of every row, in Arrow batches."""

        @F.pandas_udf("double")
        def predicted(columns: pd.DataFrame) -> pd.Series:
            codes = self.binning.codes([columns[c].to_numpy() for c in columns.columns])
            return pd.Series(self.predict(codes))

        return df.withColumn("prediction", predicted(F.struct(*_inputs(self.binning.numbers, self.binning.categories))))

    def split_shares(self) -> list[float]:
        """Share of each feature in the gain of all splits; zeros where no tree has one."""
        gains = np.zeros(len(self.binning.columns))
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain, strict=True):
                if f >= 0:
                    gains[f] += gain
        return (gains / (gains.sum() or 1.0)).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        """Settings as one JSON line below ``path``, and a table of the nodes."""
        head = {"params": asdict(self.params), "binning": asdict(self.binning), "start": self.start}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")
        rows = [
            (number, node, *values)
            for number, tree in enumerate(self.trees)
            for node, values in enumerate(zip(*asdict(tree).values(), strict=True))
        ]
        spark.createDataFrame(rows, _NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        head = json.loads(spark.read.text(f"{path}/settings").first()[0])
        lists = head["binning"]
        binning = Binning(
            tuple(lists["numbers"]), tuple(lists["categories"]), *(tuple(map(tuple, lists[n])) for n in ("bounds", "labels"))
        )
        trees: dict[int, Tree] = {}
        for row in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            tree = trees.setdefault(row.tree, Tree())
            for name in asdict(tree):
                getattr(tree, name).append(row[name])
        return BoostedTrees(TreeParams(**head["params"]), binning, head["start"], list(trees.values()))


_NODE_SCHEMA = (
    "tree int, node int, feature int, left_codes array<int>, left int, right int, value double, rows long, gain double"
)


def _inputs(numbers: Sequence[str], categories: Sequence[str]) -> list[Column]:
    return [
        *[F.col(c).cast("double").alias(c) for c in numbers],
        *[F.col(c).cast("string").alias(c) for c in categories],
    ]


def fit_binnings(
    rows: DataFrame, parts: dict[int, Column], numbers: Sequence[str], categories: Sequence[str], target: str
) -> dict[int, tuple[Binning, float, float, int]]:
    """Bins, mean, largest distance from it and row count of each part of ``rows``, in one pass.

    Bounds of a number are its quantiles; labels are all that a part has, and more than fit a byte are an error.
    """
    shares = F.array(*[F.lit(k / (BINS - 1)) for k in range(1, BINS - 1)])
    found = []
    for k, part in parts.items():
        y = F.when(part, F.col(target))
        found += [F.percentile_approx(F.when(part, F.col(c)), shares, 10_000).alias(f"n{k}_{i}") for i, c in enumerate(numbers)]
        found += [F.collect_set(F.when(part, F.col(c))).alias(f"c{k}_{i}") for i, c in enumerate(categories)]
        found += [F.avg(y).alias(f"mean{k}"), F.min(y).alias(f"low{k}"), F.max(y).alias(f"high{k}"), F.count(y).alias(f"rows{k}")]
    row = rows.agg(*found).first()
    out = {}
    for k in parts:
        labels = [tuple(sorted(row[f"c{k}_{i}"])) for i in range(len(categories))]
        if any(len(have) >= BINS for have in labels):
            raise ValueError(f"a category has more than {BINS - 1} labels")
        bounds = tuple(tuple(sorted(set(row[f"n{k}_{i}"] or ()))) for i in range(len(numbers)))
        mean = round(row[f"mean{k}"] or 0.0, 2)
        largest = max(abs((row[f"high{k}"] or 0.0) - mean), abs((row[f"low{k}"] or 0.0) - mean))
        out[k] = (Binning(tuple(numbers), tuple(categories), bounds, tuple(labels)), mean, largest, row[f"rows{k}"])
    return out


def train_parts(
    rows: DataFrame,
    parts: dict[int, Column],
    numbers: Sequence[str],
    categories: Sequence[str],
    target: str,
    params: TreeParams,
    local_rows: int = LOCAL_ROWS,
) -> dict[int, BoostedTrees]:
    """A model for each part of ``rows`` that has rows; a part is given by its number and a condition."""
    spark = rows.sparkSession
    fitted = {k: f for k, f in fit_binnings(rows, parts, numbers, categories, target).items() if f[3]}
    binnings = {k: f[0] for k, f in fitted.items()}
    member = [F.coalesce(parts[k], F.lit(False)).alias(f"p{k}") for k in binnings]
    plain = rows.select(*_inputs(numbers, categories), F.col(target).cast("double").alias("target"), *member)
    names = [*numbers, *categories]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            for k, binning in binnings.items():
                chosen = np.flatnonzero(batch.column(f"p{k}").to_numpy(zero_copy_only=False))
                codes = binning.codes([c[chosen] for c in columns])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k] * len(chosen), pa.int32()),
                        pa.array([row.tobytes() for row in codes], pa.binary()),
                        pa.array(np.asarray(batch.column("target"))[chosen], pa.float64()),
                    ],
                    ["part", "codes", "target"],
                )

    path = scratch_path(spark, "binned-rows")
    plain.mapInArrow(encode, "part int, codes binary, target double").write.partitionBy("part").parquet(path)
    binned = spark.read.schema("codes binary, target double, part int").parquet(path)
    units = {k: gradient_unit(largest, count) for k, (_, _, largest, count) in fitted.items()}
    starts = {k: mean for k, (_, mean, _, _) in fitted.items()}
    small = [k for k, f in fitted.items() if f[3] <= local_rows]

    def grow(table: pa.Table) -> pa.Table:
        k = table.column("part")[0].as_py()
        codes = _code_matrix(table.column("codes"))
        made = grow_locally(codes, np.asarray(table.column("target")), starts[k], units[k], len(categories), params)
        trees = [json.dumps(asdict(tree)) for tree in made]
        return pa.table(
            [pa.array([k] * len(trees), pa.int32()), pa.array(range(len(trees)), pa.int32()), pa.array(trees, pa.string())],
            names=["part", "number", "tree"],
        )

    grown: dict[int, list[Tree]] = {}
    if small:
        # Parts go to tasks of their own, each in a range by itself.
        one = binned.where(F.col("part").isin(small)).repartitionByRange(PART_TASKS, "part").groupBy("part").applyInArrow(grow, "part int, number int, tree string")
        for row in sorted(one.collect(), key=lambda r: (r.part, r.number)):
            grown.setdefault(row.part, []).append(Tree(**json.loads(row.tree)))
    for k in fitted.keys() - set(small):
        part = binned.where(F.col("part") == k)
        grown[k] = grow_by_jobs(part, starts[k], units[k], len(names), len(categories), params)
    return {k: BoostedTrees(params, binnings[k], starts[k], grown.get(k, [])) for k in fitted}


# Attribution --------------------------------------------------------------------


class _Paths:
    """Ways from the root to the leaves of a tree that split on as many features, with tables of their shares.

    A path has for each of its features the codes that stay on it, and the share of the rows that stayed when the
    feature was not known. A row's contribution depends on which of the features keep it on the path: a table has the
    Shapley values for each such pattern.
    """

    def __init__(self, paths: list[tuple[list[int], np.ndarray, np.ndarray, float]]) -> None:
        self.features = np.array([p[0] for p in paths])
        width = self.features.shape[1]
        self.stays = np.array([p[1] for p in paths]) * (1 << np.arange(width))[None, :, None]
        share, value = np.array([p[2] for p in paths]), np.array([p[3] for p in paths])
        pattern = (np.arange(1 << width)[:, None] >> np.arange(width)) & 1
        # Coefficients by number of known features, for each feature left out.
        terms = np.zeros((len(paths), 1 << width, width, width))
        terms[..., 0] = 1.0
        for j in range(width):
            grown = terms * share[:, j, None, None, None]
            grown[..., 1:] += terms[..., :-1] * pattern[None, :, j, None, None]
            grown[:, :, j] = terms[:, :, j]
            terms = grown
        weights = np.array([factorial(k) * factorial(width - k - 1) / factorial(width) for k in range(width)])
        self.table = (terms @ weights) * (pattern[None] - share[:, None]) * value[:, None, None]

    def add(self, codes: np.ndarray, out: np.ndarray) -> None:
        count, (paths, width) = len(codes), self.features.shape
        pattern = np.zeros((count, paths), np.int64)
        number = np.arange(paths)
        for j in range(width):
            pattern += self.stays[number, j, codes[:, self.features[:, j]]]
        values = self.table[number, pattern]
        places = np.arange(count)[:, None, None] * out.shape[1] + self.features[None]
        out += np.bincount(places.ravel(), values.ravel(), out.size).reshape(out.shape)


def tree_paths(tree: Tree) -> tuple[list[_Paths], float]:
    """The paths of a tree by number of features, and the mean of its leaves by rows."""
    found: dict[int, list] = {}
    base = 0.0
    walk = Walk(tree)

    def visit(node: int, known: dict[int, tuple[np.ndarray, float]], share: float) -> None:
        nonlocal base
        f = tree.feature[node]
        if f < 0:
            base += share * tree.value[node]
            if known:
                features = list(known)
                stays, parts = np.array([known[g][0] for g in features]), np.array([known[g][1] for g in features])
                found.setdefault(len(features), []).append((features, stays, parts, tree.value[node]))
            return
        before, part = known.get(f, (np.ones(BINS, bool), 1.0))
        for child, goes in ((tree.left[node], walk.goes_left[node]), (tree.right[node], ~walk.goes_left[node])):
            ratio = tree.rows[child] / tree.rows[node]
            visit(child, known | {f: (before & goes, part * ratio)}, share * ratio)

    visit(0, {}, 1.0)
    return [_Paths(paths) for paths in found.values()], base


def attributions(model: BoostedTrees, codes: np.ndarray) -> tuple[np.ndarray, float]:
    """Shapley value of each feature for each row, and the base: together they are the prediction.

    Features that are not known follow both branches of a split by the rows that took them in training.
    """
    out, base = np.zeros((len(codes), len(model.binning.columns))), model.start
    for tree in model.trees:
        groups, mean = tree_paths(tree)
        base += mean
        for group in groups:
            group.add(codes, out)
    return out, base


def explain(model: BoostedTrees, df: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """``kept`` columns, an array with the attribution of each feature, ``base`` and ``prediction`` of every row.

    Rows are dealt to tasks and explained ``EXPLAINED_ROWS`` at a time.
    """
    inputs = model.binning.columns
    inner = [f"x{k}" for k in range(len(inputs))]
    columns = [c.alias(n) for c, n in zip(_inputs(model.binning.numbers, model.binning.categories), inner, strict=True)]
    plain = df.select(*kept, *columns)
    # A row takes milliseconds, so small files are dealt to more tasks.
    plain = plain.repartition(max(1, -(-plain.count() // EXPLAINED_ROWS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= EXPLAINED_ROWS:
                yield from explained(pa.Table.from_batches(held))
                held = []
        if held:
            yield from explained(pa.Table.from_batches(held))

    def explained(table: pa.Table) -> Iterator[pa.RecordBatch]:
        codes = model.binning.codes([table.column(n).to_numpy() for n in inner])
        for first in range(0, len(codes), EXPLAINED_ROWS):
            part = codes[first : first + EXPLAINED_ROWS]
            values, base = attributions(model, part)
            arrays = [table.column(c).slice(first, len(part)).combine_chunks() for c in kept]
            arrays += [pa.array(list(values), pa.list_(pa.float64())), pa.array([base] * len(part)), pa.array(model.predict(part))]
            yield pa.RecordBatch.from_arrays(
                [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays],
                [*kept, "attribution", "base", "prediction"],
            )

    types = {f.name: f.dataType.simpleString() for f in plain.schema.fields}
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in kept], "attribution array<double>", "base double", "prediction double"])
    return plain.mapInArrow(run, schema)
