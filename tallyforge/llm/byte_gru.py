"""Language of a text by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes: runs of non-blank bytes, A-Z in lower case, cut at ``WINDOW`` bytes. It gives every
byte position a probability for each language, from the bytes before and behind it in its window. A text's language is
the one with the largest sum of log probabilities over all positions of windows with letters. Since a window's result
depends on its bytes only, equal windows are computed once and remembered by the task, up to a bound.

Training is numpy back-propagation through time on the driver, on a bounded sample: of each language about
``SAMPLE_TEXTS`` texts (chosen by the hash of their id) and of each of these at most ``SAMPLE_WINDOWS`` windows, spread over the whole text. The number of
languages is that of the label, which is taken to be small. Every text is predicted from all of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.corpus import LOWER, Piece, byte_words, fold, text_pieces

WINDOW, HIDDEN = 24, 24
SAMPLE_TEXTS, SAMPLE_WINDOWS = 1500, 40
STEPS, BATCH, RATE, SEED = 500, 512, 0.01, 7
# Windows whose result a task remembers, and windows computed at once.
REMEMBERED, AT_ONCE = 300_000, 4096
PAD = 256

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class ByteGru:
    """Two GRU layers side by side, one for each direction, and a softmax at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        scale = 1 / np.sqrt(hidden)

        def new(*shape):
            return rng.uniform(-scale, scale, shape).astype(np.float32)

        # Columns of a layer: update gate, reset gate, candidate.
        self.weights = {
            f"{part}{way}": new(*shape)
            for way in "fb"
            for part, shape in (("in", (257, 3 * hidden)), ("to", (hidden, 3 * hidden)))
        }
        self.weights["out"] = new(2 * hidden, len(languages))
        self.weights["bias"] = np.zeros(len(languages), dtype=np.float32)

    def _layer(self, symbols: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States behind each position, time first; padded positions keep the state."""
        into, to = self.weights["in" + way], self.weights["to" + way]
        size = to.shape[0]
        state = np.zeros((symbols.shape[1], size), dtype=np.float32)
        out = np.empty((*symbols.shape, size), dtype=np.float32)
        for t in range(len(symbols)) if way == "f" else range(len(symbols) - 1, -1, -1):
            x = into[symbols[t]]
            gates = _sigmoid(x[:, : 2 * size] + state @ to[:, : 2 * size])
            update, reset = gates[:, :size], gates[:, size:]
            back = state @ to[:, 2 * size :]
            candidate = np.tanh(x[:, 2 * size :] + reset * back)
            new = state + mask[t][:, None] * update * (candidate - state)
            if keep is not None:
                keep.append((t, state, update, reset, back, candidate))
            out[t] = state = new
        return out

    def log_probabilities(self, symbols: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._layer(symbols, mask, way) for way in "fb"], axis=2)
        return self._softmax(both)

    def _softmax(self, both: np.ndarray) -> np.ndarray:
        logits = both @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(2, keepdims=True))

    def gradients(self, symbols: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        """Mean loss of the positions and its gradients, by back-propagation through time."""
        kept = {"f": [], "b": []}
        both = np.concatenate([self._layer(symbols, mask, way, kept[way]) for way in "fb"], axis=2)
        logp = self._softmax(both)
        count = mask.sum()
        picked = np.take_along_axis(logp, np.broadcast_to(labels[None, :, None], (*symbols.shape, 1)), 2)[..., 0]
        delta = np.exp(logp)
        rows = np.arange(symbols.shape[1])
        delta[:, rows, labels] -= 1
        delta *= mask[..., None] / count
        size = self.weights["tof"].shape[0]
        found = {"out": np.einsum("tbh,tbl->hl", both, delta), "bias": delta.sum((0, 1))}
        above = delta @ self.weights["out"].T
        for k, way in enumerate("fb"):
            to = self.weights["to" + way]
            d_into, d_to = np.zeros_like(self.weights["in" + way]), np.zeros_like(to)
            carried = np.zeros((symbols.shape[1], size), dtype=np.float32)
            for t, state, update, reset, back, candidate in reversed(kept[way]):
                d_state = carried + above[t][:, k * size : (k + 1) * size]
                on = mask[t][:, None]
                d_update = d_state * on * (candidate - state) * update * (1 - update)
                d_candidate = d_state * on * update * (1 - candidate**2)
                d_reset = d_candidate * back * reset * (1 - reset)
                d_back = d_candidate * reset
                d_gates = np.concatenate([d_update, d_reset], 1)
                np.add.at(d_into, symbols[t], np.concatenate([d_gates, d_candidate], 1))
                d_to[:, : 2 * size] += state.T @ d_gates
                d_to[:, 2 * size :] += state.T @ d_back
                carried = d_state * (1 - on * update) + d_gates @ to[:, : 2 * size].T + d_back @ to[:, 2 * size :].T
            found["in" + way], found["to" + way] = d_into, d_to
        return float(-(picked * mask).sum() / count), found

    def fit(self, windows: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> list[float]:
        """Adam over batches of windows of like length; the losses."""
        rng = np.random.default_rng(seed)
        order = np.argsort([len(w) for w in windows], kind="stable")
        moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in self.weights.items()}
        losses = []
        for step in range(1, steps + 1):
            start = rng.integers(0, max(1, len(order) - BATCH + 1))
            chosen = order[start : start + BATCH]
            symbols, mask = padded([windows[i] for i in chosen])
            loss, found = self.gradients(symbols, mask, labels[chosen])
            losses.append(loss)
            rate = RATE * (1 - step / (steps + 1))
            for k, g in found.items():
                first, second = moments[k]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                self.weights[k] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        return losses

    def window_sums(self, windows: list[bytes]) -> np.ndarray:
        """Sum over its positions of each window's log probabilities."""
        out = np.empty((len(windows), len(self.languages)), dtype=np.float32)
        order = np.argsort([len(w) for w in windows], kind="stable")
        for start in range(0, len(order), AT_ONCE):
            chosen = order[start : start + AT_ONCE]
            symbols, mask = padded([windows[i] for i in chosen])
            out[chosen] = np.einsum("tbl,tb->bl", self.log_probabilities(symbols, mask), mask)
        return out


def padded(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and mask, time first."""
    length = max(map(len, windows))
    flat = np.frombuffer(b"".join(w.ljust(length, b"\0") for w in windows), dtype=np.uint8)
    sizes = np.array([len(w) for w in windows])
    mask = np.arange(length)[:, None] < sizes[None, :]
    symbols = flat.reshape(len(windows), length).T.astype(np.int64)
    return np.where(mask, symbols, PAD), mask.astype(np.float32)


def _letter_windows(piece: Piece):
    """Code, first byte and length of the windows with a letter, bounds of the texts, and the lowered bytes."""
    found = byte_words(piece, WINDOW)
    if not len(found.codes):
        return found.codes, found.starts, found.lengths, found.bounds, piece.data
    count = np.concatenate([[0], np.cumsum(_LETTER[piece.data])])
    has = count[found.starts + found.lengths] > count[found.starts]
    bounds = np.concatenate([[0], np.cumsum(has)])[found.bounds]
    return found.codes[has], found.starts[has], found.lengths[has], bounds, LOWER[piece.data]


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in text_pieces(batch.column(0)):
            _, starts, lengths, bounds, data = _letter_windows(piece)
            rows, windows = [], []
            for row, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                step = max(1, (last - first) // SAMPLE_WINDOWS)
                for k in range(first, last, step)[:SAMPLE_WINDOWS]:
                    rows.append(piece.first + row)
                    windows.append(data[starts[k] : starts[k] + lengths[k]].tobytes())
            langs = batch.column(1).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([langs, pa.array(windows, pa.binary())], ["lang", "window"])


def train(docs: DataFrame) -> ByteGru | None:
    """Network trained on a bounded sample of rows with text, lang and doc_id; None where there are none."""
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    # One row for each language; texts by the hash of their id, SAMPLE_TEXTS of each language on average.
    counts = labelled.groupBy("lang").agg(F.count("*").alias("texts"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = labelled.join(F.broadcast(counts), "lang").where(share * F.col("texts") < SAMPLE_TEXTS)
    sample = chosen.select("text", "lang")
    rows = sample.mapInArrow(_sample_windows, "lang string, window binary").toArrow().to_pandas()
    if not len(rows):
        return None
    rows = rows.assign(window=rows["window"].map(bytes)).sort_values(["lang", "window"], kind="stable")
    languages = sorted(rows["lang"].unique())
    labels = rows["lang"].map({lang: k for k, lang in enumerate(languages)}).to_numpy(np.int64)
    model = ByteGru(languages)
    model.fit(list(rows["window"]), labels)
    return model


def _predict(model: ByteGru):
    names = np.array(model.languages, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}
        table = np.empty((0, len(names)), dtype=np.float32)
        for batch in batches:
            for piece in text_pieces(batch.column(1)):
                codes, starts, lengths, bounds, data = _letter_windows(piece)
                found, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
                if len(table) > REMEMBERED:
                    known, table = {}, table[:0]
                new = [k for k, code in enumerate(found.tolist()) if code not in known]
                if new:
                    windows = [
                        data[s : s + n].tobytes() for s, n in zip(starts[first[new]], lengths[first[new]], strict=True)
                    ]
                    known.update(zip(found[new].tolist(), range(len(table), len(table) + len(new)), strict=True))
                    table = np.concatenate([table, model.window_sums(windows)])
                place = np.fromiter(map(known.__getitem__, found.tolist()), dtype=np.int64, count=len(found))
                totals = np.concatenate([np.zeros((1, len(names))), np.cumsum(table[place[inverse]], 0, dtype=float)])
                positions = np.concatenate([[0], np.cumsum(lengths)])
                sums = totals[bounds[1:]] - totals[bounds[:-1]]
                count = positions[bounds[1:]] - positions[bounds[:-1]]
                mean = np.exp(sums / np.maximum(count, 1)[:, None])
                best = sums.argmax(1)
                share = mean[np.arange(len(best)), best] / mean.sum(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.last - piece.first),
                        batch.column(2).slice(piece.first, piece.last - piece.first),
                        pa.array(names[best], pa.string()),
                        pa.array(share, pa.float64()),
                    ],
                    ["doc_id", "has_letter", "lang_pred", "score"],
                )

    return run


def predict(docs: DataFrame, model: ByteGru | None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, lang_pred, score (0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or where nothing could be learned. Ties go to the
    language first in order. Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", letter.alias("has_letter"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    found = rows.mapInArrow(_predict(model), "doc_id long, has_letter boolean, lang_pred string, score double")
    return found.select(
        "doc_id",
        F.when(F.col("has_letter"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("has_letter"), F.col("score")).otherwise(0.0).alias("score"),
    )


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Learn from the documents outside fold 0 and predict all of them; adds held_out."""
    rest = fold(F.col("doc_id"), folds)
    found = predict(docs, train(docs.where(rest != 0)))
    held = F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
