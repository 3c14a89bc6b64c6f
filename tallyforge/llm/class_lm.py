"""Class-based bigram language model (Brown et al.) with exchange clustering, trained and applied at corpus scale.

A text is its words (A-Z in lower case) and one end. With class c(w) of a word, the model scores
``P(w | previous) = P(c(w) | c(previous)) * P(w | c(w))``; the previous of the first word is the end.

Training reads every training text whole, in passes that each aggregate within the task before the shuffle:

1. counts of all words (a table in the shared folder; it grows with the corpus);
2. bigram counts among the ``CORE`` most frequent words; the exchange algorithm assigns these to classes on the driver,
   moving each word to the class that raises the likelihood most, until few words move;
3. counts of core classes beside each further word of the broadcast table; one exchange step for each of these words,
   in tasks, puts it into its best class;
4. counts of class transitions over all words, and counts of classes beside each word that has none yet: words outside
   the table, and those that never stand beside the core. One exchange step for each of these, in tasks, against the
   transitions of the others. Their classes are rows of a table, and so are pairs of such words, whose transitions are
   found by joins.

So every word met at least twice gets its class by its own neighbours, however large the vocabulary is; a word that
stands beside such words alone ties, and ties go to the lowest class. What is broadcast is bounded: the table holds the
most frequent words, ``TABLED`` at most, cut by count and never by memory. Words outside it find counts and classes by
a join; such a word is rare, so no key of that join is hot.

Transitions and emissions are smoothed by adding a constant and sum to 1. The last class is that of unknown words. Words
met once stand for these and share it, and the one place that unknown words have there weighs as much as all of them (the
Good-Turing share of unseen words). Words are compared by 64-bit codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.corpus import byte_words, fold, stored, text_pieces

CORE, TABLED = 1024, 1 << 19
CLASSES, SWEEPS = 48, 6
# Added to a class transition and to a word of a class.
TRANSITION_PRIOR, EMISSION_PRIOR = 0.1, 0.1
# Code of the end of a text; ids of words outside a vocabulary.
END = np.uint64(1)
# Distinct words that a task gathers before it sends them; words in a group of the exchange step.
GATHERED, BLOCK = 1 << 21, 1 << 13
# What stands beside a word without a known class: a class before it, a class behind it, or another such word before it.
BEFORE, BEHIND, OPEN = 0, CLASSES + 1, 2 * (CLASSES + 1)
CONTEXT = np.dtype([("code", "<u8"), ("context", "<i4"), ("n", "<i4")])
PAIR = np.dtype([("left", "<u8"), ("right", "<u8"), ("n", "<i8")])


@dataclass(frozen=True)
class Vocabulary:
    """Most frequent words: sorted codes and their counts."""

    codes: np.ndarray
    counts: np.ndarray

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Place of each code, or -1."""
        if not len(self.codes):
            return np.full(len(codes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, -1)


def _sequences(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, codes with an end behind each text, and the places of the ends."""
    for piece in text_pieces(column):
        found = byte_words(piece)
        rows = piece.last - piece.first
        ends = found.bounds[1:] + np.arange(rows)
        codes = np.empty(len(found.codes) + rows, dtype=np.uint64)
        word = np.ones(len(codes), dtype=bool)
        word[ends] = False
        codes[word], codes[ends] = found.codes, END
        yield piece.first, piece.last, codes, ends


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def batch_of(codes, counts):
        return pa.RecordBatch.from_arrays([_signed(codes), pa.array(counts)], ["code", "n"])

    for batch in batches:
        for _, _, sequence, _ in _sequences(batch.column(0)):
            new, times = np.unique(sequence, return_counts=True)
            codes, inverse = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, times]), len(codes)).astype(np.int64)
            if len(codes) > GATHERED:
                yield batch_of(codes, counts)
                codes, counts = codes[:0], counts[:0]
    if len(codes):
        yield batch_of(codes, counts)


def _count_pairs(places, width: int):
    """Sum over the training texts of neighbours (left * width + right), where both have a place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, dtype=np.int64)
        for batch in batches:
            for _, _, codes, _ in _sequences(batch.column(0)):
                here = places(codes)
                left = np.concatenate([places(codes[-1:] * 0 + END), here[:-1]])
                both = (here >= 0) & (left >= 0)
                total += np.bincount(left[both] * width + here[both], minlength=width * width)
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total[keys])], ["pair", "n"])

    return run


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Classes of words from their dense bigram counts, by the exchange algorithm.

    Words come by falling count and start in class ``place % classes``. A word moves to the class with the largest
    ``sum N(a, b) log N(a, b) - 2 sum N(a) log N(a)``; ties go to the lower class.
    """
    words = len(pairs)
    label = np.arange(words) % classes
    if words <= classes:
        return label
    member = np.zeros((words, classes))
    member[np.arange(words), label] = 1
    pairs = pairs.astype(float)
    before, after = (member.T @ pairs).T, pairs @ member  # of each word: counts of classes before and behind it
    grid = member.T @ after
    own = np.diag(pairs)

    def info(x):
        return x * np.log(np.where(x > 0, x, 1))

    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            old = label[w]
            left, right, self_count = before[w].copy(), after[w].copy(), own[w]
            left[old] -= self_count
            right[old] -= self_count
            base = grid.copy()
            base[:, old] -= left
            base[old, :] -= right
            base[old, old] -= self_count
            rows, columns = base.sum(1), base.sum(0)
            # Entries that change when w enters class k: its row, its column, and where they cross.
            gain = info(base + right).sum(1) - info(base).sum(1) + info(base + left[:, None]).sum(0) - info(base).sum(0)
            cross = base.diagonal()
            gain += info(cross + left + right + self_count) - info(cross + right) - info(cross + left) + info(cross)
            n_right, n_left = right.sum() + self_count, left.sum() + self_count
            gain -= info(rows + n_right) - info(rows) + info(columns + n_left) - info(columns)
            new = int(np.argmax(gain))
            grid = base
            grid[:, new] += left
            grid[new, :] += right
            grid[new, new] += self_count
            if new != old:
                moved += 1
                label[w] = new
                # Neighbours see w in its new class.
                before[:, old] -= pairs[w]
                before[:, new] += pairs[w]
                after[:, old] -= pairs[:, w]
                after[:, new] += pairs[:, w]
        if moved * 100 < words:
            break
    return label


def _context_counts(table: Vocabulary, core_class: np.ndarray, classes: int):
    """For words of the table outside the core: counts of core classes before and behind them."""
    width = 2 * classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def send():
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            block = keys // (width * BLOCK)
            found, first = np.unique(block, return_index=True)
            packed = np.stack([keys, times], 1)
            return pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array([p.tobytes() for p in np.split(packed, first[1:])], pa.binary())],
                ["block", "counts"],
            )

        for batch in batches:
            for _, _, codes, ends in _sequences(batch.column(0)):
                here = table.find(codes)
                label = np.where(here >= 0, core_class[here], -1)
                wanted = (here >= 0) & (label < 0)
                at = np.flatnonzero(wanted)
                before = np.where(at > 0, label[at - 1], label[ends[0]])
                # Nothing stands behind the last end of a batch.
                behind = np.append(label, -1)[at + 1]
                for side, context in ((0, before), (classes, behind)):
                    known = context >= 0
                    held.append(here[at[known]] * width + side + context[known])
                    size += int(known.sum())
                if size >= GATHERED:
                    yield send()
                    held.clear()
                    size = 0
        if size:
            yield send()

    return run


def _best_class(grid: np.ndarray):
    """Exchange step for each word of a block, given the core's class bigram counts."""
    classes = len(grid)
    row, column = grid.sum(1), grid.sum(0)
    enter = np.log((grid + 0.5) / (column[None, :] + 0.5 * classes))  # class a before a word of class k
    leave = np.log((grid + 0.5) / (row[:, None] + 0.5 * classes))  # class b behind a word of class k

    def run(group: pd.DataFrame) -> pd.DataFrame:
        packed = np.concatenate([np.frombuffer(x, dtype=np.int64).reshape(-1, 2) for x in group["counts"]])
        word, context = packed[:, 0] // (2 * classes), packed[:, 0] % (2 * classes)
        words, place = np.unique(word, return_inverse=True)
        table = np.zeros((len(words), 2 * classes))
        np.add.at(table, (place, context), packed[:, 1])
        gain = table[:, :classes] @ enter + table[:, classes:] @ leave.T
        return pd.DataFrame({"place": words, "class": gain.argmax(1)})

    return run


class Neighbours(NamedTuple):
    """Tokens of a batch by what is known of them and of the token before them; places of each kind.

    ``label``: class of each token, -1 where it is open; ``before``: the same of the token before it.
    """

    label: np.ndarray
    before: np.ndarray
    left: np.ndarray  # code of the token before
    closed: np.ndarray  # both classes known
    entered: np.ndarray  # open behind a known class
    left_open: np.ndarray  # a known class behind an open word
    both_open: np.ndarray


def _neighbours(codes: np.ndarray, label_of) -> Neighbours:
    """The token before the first one is an end."""
    left = np.concatenate([codes[-1:] * 0 + END, codes[:-1]])
    label = label_of(codes)
    before = np.concatenate([label_of(left[:1]), label[:-1]])
    known, known_before = label >= 0, before >= 0
    kinds = (known & known_before, ~known & known_before, known & ~known_before, ~known & ~known_before)
    return Neighbours(label, before, left, *map(np.flatnonzero, kinds))


def _moves(label_of, buckets: int):
    """Transitions between known classes (kind 0), contexts of open words by bucket (1), pairs of open words (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + 1) ** 2, dtype=np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        pairs: list[np.ndarray] = []

        def batch_of(kind: int, buckets: list[int], packed: list[bytes]) -> pa.RecordBatch:
            columns = [pa.array([kind] * len(packed), pa.int32()), pa.array(buckets, pa.int64()), pa.array(packed, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "counts"])

        def send() -> Iterator[pa.RecordBatch]:
            if any(len(c) for c, _ in held):
                words, place = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
                keys, times = np.unique(place * (OPEN + 1) + np.concatenate([x for _, x in held]), return_counts=True)
                rows = np.empty(len(keys), dtype=CONTEXT)
                rows["code"], rows["context"], rows["n"] = words[keys // (OPEN + 1)], keys % (OPEN + 1), times
                bucket = (rows["code"] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                found, first = np.unique(bucket[order], return_index=True)
                yield batch_of(1, found.tolist(), [part.tobytes() for part in np.split(rows[order], first[1:])])
            if pairs:
                yield batch_of(2, [-1], [np.concatenate(pairs).tobytes()])
            held.clear()
            pairs.clear()

        for batch in batches:
            for _, _, codes, _ in _sequences(batch.column(0)):
                at = _neighbours(codes, label_of)
                both = at.before[at.closed] * (CLASSES + 1) + at.label[at.closed]
                total += np.bincount(both, minlength=len(total))
                held.append((codes[at.entered], BEFORE + at.before[at.entered]))
                held.append((at.left[at.left_open], BEHIND + at.label[at.left_open]))
                held.append((codes[at.both_open], np.full(len(at.both_open), OPEN)))
                if len(at.both_open):
                    rows = np.empty(len(at.both_open), dtype=PAIR)
                    rows["left"], rows["right"], rows["n"] = at.left[at.both_open], codes[at.both_open], 1
                    pairs.append(rows)
                size += sum(len(c) for c, _ in held[-3:])
                if size >= GATHERED:
                    yield from send()
                    size = 0
        yield from send()
        yield batch_of(0, [-1], [total.tobytes()])

    return run


def _close(grid: np.ndarray):
    """Exchange step for each open word of a bucket that was met twice or more, given transitions of the known classes.

    Rows of kind 0: code, class, count. Rows of kind 1: a transition (left * width + right) and its count.
    """
    width = CLASSES + 1
    enter = np.log((grid[:, :CLASSES] + 0.5) / (grid.sum(0)[None, :CLASSES] + 0.5 * width))
    leave = np.log((grid[:CLASSES] + 0.5) / (grid.sum(1)[:CLASSES, None] + 0.5 * width))

    def run(group: pa.Table) -> pa.Table:
        packed = np.frombuffer(b"".join(group.column("counts").to_pylist()), dtype=CONTEXT)
        words, place = np.unique(packed["code"], return_inverse=True)
        label, times = np.full(len(words), CLASSES), np.zeros(len(words), dtype=np.int64)
        steps = np.zeros((width, width), dtype=np.int64)
        order = np.argsort(place, kind="stable")
        packed, place = packed[order], place[order]
        for first in range(0, len(words), BLOCK):
            last = min(first + BLOCK, len(words))
            begin, end = np.searchsorted(place, [first, last])
            cells = (place[begin:end] - first) * (OPEN + 1) + packed["context"][begin:end]
            table = np.bincount(cells, packed["n"][begin:end], (last - first) * (OPEN + 1)).reshape(last - first, -1)
            before, behind = table[:, BEFORE:BEHIND], table[:, BEHIND:OPEN]
            # Every token has one before it.
            times[first:last] = before.sum(1) + table[:, OPEN]
            best = (before @ enter + behind @ leave.T).argmax(1)
            label[first:last] = np.where(times[first:last] > 1, best, CLASSES)
            member = np.eye(width)[label[first:last]]
            steps += (before.T @ member + member.T @ behind).astype(np.int64)
        classed = np.flatnonzero(label < CLASSES)
        moved = np.flatnonzero(steps)
        return pa.table(
            {
                "kind": pa.array([0] * len(classed) + [1] * len(moved), pa.int32()),
                "code": pa.concat_arrays([_signed(words[classed]), pa.array(moved)]),
                "class": pa.array(np.concatenate([label[classed], np.zeros(len(moved), np.int64)])),
                "n": pa.array(np.concatenate([times[classed], steps.ravel()[moved]])),
            }
        )

    return run


def _unpack_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((CLASSES + 1) ** 2, dtype=np.int64)
    for batch in batches:
        for packed in batch.column(0):
            total += np.frombuffer(packed.as_buffer(), dtype=np.int64)
    keys = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total[keys])], ["pair", "n"])


def _unpack_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(0):
            rows = np.frombuffer(packed.as_buffer(), dtype=PAIR)
            for first in range(0, len(rows), 1 << 16):
                part = rows[first : first + (1 << 16)]
                columns = [_signed(part[name]) for name in PAIR.names]
                yield pa.RecordBatch.from_arrays(columns, ["left", "right", "n"])


def _open_transitions(moves: DataFrame, classes: DataFrame) -> np.ndarray:
    """Counts of transitions from one open word to another. ``classes``: code, class; words met once have no row."""
    pairs = moves.where("kind = 2").select("counts").mapInArrow(_unpack_pairs, "left long, right long, n long")
    pairs = pairs.join(classes.select(F.col("code").alias("left"), F.col("class").alias("from")), "left", "left")
    pairs = pairs.join(classes.select(F.col("code").alias("right"), F.col("class").alias("to")), "right", "left")
    last = F.lit(CLASSES)
    sums = pairs.groupBy(F.coalesce("from", last).alias("from"), F.coalesce("to", last).alias("to")).agg(F.sum("n"))
    out = np.zeros((CLASSES + 1, CLASSES + 1), dtype=np.int64)
    for row in sums.toArrow().to_pandas().to_numpy(np.int64):
        out[row[0], row[1]] = row[2]
    return out


@dataclass(frozen=True)
class ClassModel:
    """What scoring needs beside the table of all words; arrays are bounded by ``TABLED`` and ``CLASSES``."""

    tokens: int
    words: int
    table: Vocabulary
    labels: np.ndarray  # class of each word of the table
    transition: np.ndarray  # log10 P(class | class)
    class_words: np.ndarray
    class_tokens: np.ndarray
    unknown: float  # weight of the place of unknown words in the last class

    def mass(self) -> np.ndarray:
        """Weight of each class, to divide emissions by."""
        mass = self.class_tokens + EMISSION_PRIOR * self.class_words
        mass[CLASSES] += self.unknown
        return mass

    def least(self) -> int:
        """Count from which on words are in the table."""
        return int(self.table.counts.min()) if len(self.table.counts) else np.iinfo(np.int64).max

    def label_of(self, codes: np.ndarray) -> np.ndarray:
        """Class of each word of the table; -1 for others."""
        at = self.table.find(codes)
        return np.where(at >= 0, self.labels[at], -1) if len(self.labels) else np.full(len(codes), -1)

    def emission(self, n: np.ndarray, label: np.ndarray) -> np.ndarray:
        return np.log10(np.where(n > 0, n + EMISSION_PRIOR, self.unknown) / self.mass()[label])


def _cut(histogram: pd.DataFrame, most: int) -> int:
    """Least count so that at most ``most`` words have it or more."""
    within = histogram["words"].cumsum() <= most
    return int(histogram["n"][within].min()) if within.any() else int(histogram["n"].max()) + 1 if len(histogram) else 1


def train(texts: DataFrame) -> tuple[ClassModel, DataFrame]:
    """Model and rows (code, n, class) of all words of the one column of whole texts; no text: a model that knows no word."""
    counted = texts.mapInArrow(_count_words, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = stored(counted, "lm-counts")
    # One row for each distinct count, most frequent first.
    histogram = counts.groupBy("n").agg(F.count("*").alias("words")).toArrow().to_pandas().sort_values("n", ascending=False)
    tokens, words = int((histogram["n"] * histogram["words"]).sum()), int(histogram["words"].sum())

    least = _cut(histogram, TABLED)
    top = counts.where(F.col("n") >= least).toArrow().to_pandas()
    codes = top["code"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(codes)
    table = Vocabulary(codes[order], top["n"].to_numpy(np.int64)[order])
    # Class of each word of the table, -1 while it is open.
    labels = np.full(len(table.codes), -1)
    by_count = np.lexsort((table.codes, -table.counts))[:CORE]
    by_count = by_count[table.counts[by_count] > 1]
    size = len(by_count)
    if size:
        places = np.sort(by_count)
        core = Vocabulary(table.codes[places], table.counts[places])
        pairs = np.zeros((size, size), dtype=np.int64)
        found = texts.mapInArrow(_count_pairs(core.find, size), "pair long, n long").groupBy("pair").agg(F.sum("n"))
        rows = found.toArrow().to_pandas().to_numpy(np.int64)
        pairs.flat[rows[:, 0]] = rows[:, 1]
        rank = np.searchsorted(places, by_count)
        core_label = np.empty(size, dtype=np.int64)
        core_label[rank] = exchange(pairs[np.ix_(rank, rank)], CLASSES, SWEEPS)
        member = np.eye(CLASSES)[core_label]
        grid = member.T @ pairs @ member

        labels[places] = core_label
        contexts = texts.mapInArrow(_context_counts(table, labels.copy(), CLASSES), "block long, counts binary")
        best = contexts.groupBy("block").applyInPandas(_best_class(grid), "place long, class long").toArrow().to_pandas()
        labels[best["place"]] = best["class"]
    labels[table.counts == 1] = CLASSES

    def label_of(codes: np.ndarray) -> np.ndarray:
        at = table.find(codes)
        return np.where(at >= 0, known[at], -1) if len(known) else np.full(len(codes), -1)

    known = labels.copy()
    rest = int((known < 0).sum()) + words - len(table.codes)
    moves = stored(texts.mapInArrow(_moves(label_of, 1 + rest // BLOCK), "kind int, bucket long, counts binary"), "lm-moves")
    steps = np.zeros((CLASSES + 1, CLASSES + 1), dtype=np.int64)
    sums = moves.where("kind = 0").select("counts").mapInArrow(_unpack_steps, "pair long, n long").groupBy("pair").agg(F.sum("n"))
    rows = sums.toArrow().to_pandas().to_numpy(np.int64)
    steps.flat[rows[:, 0]] = rows[:, 1]
    closing = moves.where("kind = 1").groupBy("bucket").applyInArrow(
        _close(steps.astype(float)), "kind int, code long, class long, n long"
    )
    closed = stored(closing, "lm-closed")
    classes = closed.where("kind = 0").select("code", "class", "n")
    more = closed.where("kind = 1").groupBy("code").agg(F.sum("n")).toArrow().to_pandas().to_numpy(np.int64)
    steps.flat[more[:, 0]] += more[:, 1]
    if rest:
        steps += _open_transitions(moves, classes)
    late = classes.where(F.col("n") >= least).toArrow().to_pandas()
    labels[table.find(late["code"].to_numpy(np.int64).view(np.uint64))] = late["class"]
    labels[labels < 0] = CLASSES

    # The last class has the words met once, and one place for an unknown word.
    class_tokens = np.bincount(labels, table.counts, CLASSES + 1)
    class_words = np.bincount(labels, minlength=CLASSES + 1).astype(float)
    outside = classes.where(F.col("n") < least).groupBy("class").agg(F.sum("n"), F.count("*"))
    for label, n, many in outside.toArrow().to_pandas().to_numpy(np.int64):
        class_tokens[label] += n
        class_words[label] += many
    class_tokens[CLASSES] += tokens - class_tokens.sum()
    class_words[CLASSES] += words - class_words.sum()
    unknown = float(histogram["words"][histogram["n"] == 1].sum()) + EMISSION_PRIOR

    # A class without words cannot follow.
    used = (class_words > 0) | (np.arange(CLASSES + 1) == CLASSES)
    steps = (steps + TRANSITION_PRIOR) * used
    transition = np.log10(np.maximum(steps / steps.sum(1, keepdims=True), 1e-300))
    model = ClassModel(tokens, words, table, labels, transition, class_words, class_tokens, unknown)
    inside = counts.where(F.col("n") >= least).withColumn("class", F.lit(None).cast("long"))
    every = counts.where(F.col("n") < least).join(classes.select("code", "class"), "code", "left")
    return model, inside.unionByName(every)


def _partial_scores(model: ClassModel):
    """For each text what the broadcast table knows, and its other words, each with what stands beside it and times."""
    table, labels, transition = model.table, model.labels, model.transition
    total = model.tokens + model.words + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, codes, ends in _sequences(batch.column(1)):
                place = table.find(codes)
                known = place >= 0
                n = np.where(known, table.counts[place], 0) if len(labels) else np.zeros(len(codes), np.int64)
                at = _neighbours(codes, model.label_of)
                model_part = np.where(known, model.emission(n, at.label), 0)
                model_part[at.closed] += transition[at.before[at.closed], at.label[at.closed]]
                base_part = np.where(known, np.log10((n + 1) / total), 0)
                heads = np.concatenate([[0], ends[:-1] + 1])
                owner = np.repeat(np.arange(last - first), ends + 1 - heads)
                spots = np.concatenate([at.entered, at.left_open, at.both_open])
                sizes = [len(at.entered), len(at.left_open), len(at.both_open)]
                none = np.zeros(sizes[0] + sizes[1], np.uint64)
                rare = pd.DataFrame(
                    {
                        "owner": owner[spots],
                        "code": np.concatenate([codes[at.entered], at.left[at.left_open], codes[at.both_open]]).view(np.int64),
                        "other": np.concatenate([none, at.left[at.both_open]]).view(np.int64),
                        "context": np.concatenate(
                            [BEFORE + at.before[at.entered], BEHIND + at.label[at.left_open], np.full(sizes[2], OPEN)]
                        ),
                    }
                )
                times = rare.groupby(["owner", "code", "other", "context"], sort=True).size()
                found = times.index.to_frame(index=False)
                bounds = np.searchsorted(found["owner"], np.arange(last - first + 1))
                offsets = pa.array(bounds.astype(np.int32))
                lists = [found["code"], found["other"], found["context"], times]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(ends + 1 - heads),
                        pa.array(np.add.reduceat(known.astype(np.int64), heads)),
                        pa.array(np.add.reduceat(base_part, heads)),
                        pa.array(np.add.reduceat(model_part, heads)),
                        *[pa.ListArray.from_arrays(offsets, pa.array(x.to_numpy(np.int64))) for x in lists],
                    ],
                    ["doc_id", "n_tokens", "n_known", "base_part", "model_part", "codes", "others", "contexts", "times"],
                )

    return run


def _rare_scores(asked: DataFrame, words: DataFrame, model: ClassModel) -> DataFrame:
    """Parts of the scores of each row that its words outside the table give. ``asked``: row, code, other, context, times."""
    last = F.lit(CLASSES).cast("long")
    rare = words.where(F.col("n") < model.least()).select("code", "n", F.coalesce("class", last).alias("class"))
    its = F.coalesce("class", last)
    one = asked.where(F.col("context") < OPEN).join(rare, "code", "left").select(
        "row",
        "times",
        F.coalesce("n", F.lit(0)).alias("n"),
        its.alias("class"),
        (F.col("context") < BEHIND).alias("met"),
        F.when(F.col("context") < BEHIND, F.col("context") * (CLASSES + 1) + its)
        .otherwise(its * (CLASSES + 1) + F.col("context") - BEHIND)
        .alias("pair"),
    )
    before = rare.select(F.col("code").alias("other"), F.col("class").alias("from"))
    two = asked.where(F.col("context") == OPEN).join(rare, "code", "left").join(before, "other", "left").select(
        "row",
        "times",
        F.coalesce("n", F.lit(0)).alias("n"),
        its.alias("class"),
        F.lit(True).alias("met"),
        (F.coalesce("from", last) * (CLASSES + 1) + its).alias("pair"),
    )
    steps = pa.table({"pair": np.arange((CLASSES + 1) ** 2), "step": model.transition.ravel()})
    every = one.unionByName(two).join(F.broadcast(asked.sparkSession.createDataFrame(steps)), "pair")
    n, times = F.col("n"), F.when(F.col("met"), F.col("times")).otherwise(0)
    mass = F.get(F.array(*map(F.lit, model.mass().tolist())), F.col("class").cast("int"))
    weight = F.when(n > 0, n + EMISSION_PRIOR).otherwise(model.unknown)
    total = float(model.tokens + model.words + 1)
    return every.groupBy("row").agg(
        F.sum(F.when(n > 0, times).otherwise(0)).alias("rare_known"),
        F.sum(times * F.log10((n + 1) / F.lit(total))).alias("rare_base"),
        F.sum(F.when(F.col("met"), times * F.log10(weight / mass)).otherwise(0) + F.col("times") * F.col("step")).alias("rare_model"),
    )


def score(docs: DataFrame, model: ClassModel, words: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Scores are log10 probabilities; perplexity is ``10 ** (-score / n_tokens)``. A null or empty text is one end.
    Repeated rows give repeated results, an empty table none; columns other than doc_id and text are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lists = ("codes", "others", "contexts", "times")
    schema = "doc_id long, n_tokens long, n_known long, base_part double, model_part double, " + ", ".join(
        f"{name} array<long>" for name in lists
    )
    parts = rows.mapInArrow(_partial_scores(model), schema).withColumn("row", F.monotonically_increasing_id())
    parts = stored(parts, "lm-parts")
    asked = parts.where(F.size("codes") > 0).select("row", F.explode(F.arrays_zip(*lists)).alias("w"))
    asked = asked.select(
        "row", F.col("w.codes").alias("code"), F.col("w.others").alias("other"), F.col("w.contexts").alias("context"), "w.times"
    )
    answers = _rare_scores(asked, words, model)
    joined = parts.drop(*lists).join(answers, "row", "left").na.fill(0, ["rare_known", "rare_base", "rare_model"])
    scored = joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.col("rare_base")).alias("base_score"),
        (F.col("model_part") + F.col("rare_model")).alias("score"),
    )
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def score_corpus(docs: DataFrame, folds: int = 7, held_out_fold: int = 2) -> DataFrame:
    """Train on the documents outside the held-out fold and score all of them; a null id is in neither."""
    held_out = fold(F.col("doc_id"), folds) == held_out_fold
    model, words = train(docs.where(~held_out).select("text"))
    return score(docs, model, words).withColumn("held_out", F.coalesce(fold(F.col("doc_id"), folds) == held_out_fold, F.lit(False)))
