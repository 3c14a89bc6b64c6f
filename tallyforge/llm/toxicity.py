"""Toxicity from a learned lexicon, met through Levenshtein automata, and the context of each hit.

Lexicon: words whose share of toxic texts, among the labelled texts that have them, is high with confidence. A word of a
text hits a term when it is the term or a misspelling of it: the automaton of all strings within the term's distance
(one edit, two from nine letters, none where clean texts have words that near) is intersected with the trie of the lexicon, so that a branch ends as soon
as no continuation can be near. Each distinct word is intersected once and remembered by the task, up to a bound; the
sets of letters of word and terms rule out most words before.

Words with signs but no blank between them are also tested joined, so that signs in a word do not hide it.

A hit counts by its context window: less where it stands in quotation marks or is reported, more where someone is
addressed. The sums of a text go through a logistic function fitted to the labels.

Lexicon and weights are fitted on a bounded sample: the ``SAMPLE`` labelled texts with the smallest id hashes. All texts
are scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.corpus import LOWER, SPACE, byte_words, documents, fold, stored, text_pieces, word_bytes

SAMPLE = 20_000
# A term: fewest toxic texts that have it, least lower confidence limit of the share of toxic texts among those that have
# it. The sample bounds the number of terms.
LEAST_TEXTS, LEAST_SHARE, CONFIDENCE_Z = 5, 0.5, 3.0
# A term allows no edits if clean texts have its neighbours more often than this share of the term's own texts.
CLEAN_NEIGHBOURS = 0.05
# Context: bytes on each side; factors of a hit that is quoted or reported, and of one that addresses someone.
CONTEXT_BYTES, QUOTED, ADDRESSED = 60, 0.3, 1.5
# Factor of a misspelled hit.
MISSPELLED = 0.8
REPORTING = {b"said", b"says", b"wrote", b"called", b"quote", b"quoted", b"word", b"term", b"slur"}
ADDRESSING = {b"you", b"your", b"youre", b"ur", b"u"}
REMEMBERED = 1_000_000
# Joined words of the sample that are counted, so that clean ones forbid edits: their longest.
JOINED_BYTES = 32
FEATURES = 3

# Words here are runs of letters and digits; bytes above 0x7F are letters.
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(0x80, 0x100)]] = False
_OPENING, _CLOSING = (b'"', "“".encode(), "«".encode(), "„".encode()), (b'"', "”".encode(), "»".encode(), "“".encode())
_LETTER_BIT = np.array([1 << (b % 64) for b in range(256)], dtype=np.uint64)[LOWER]


def edits_allowed(term: bytes) -> int:
    return 1 if len(term) < 9 else 2


@dataclass
class TrieNode:
    children: dict[int, TrieNode] = field(default_factory=dict)
    term: int = -1
    # Largest distance allowed to any term below.
    most: int = 0


class Lexicon:
    """Terms in a trie, searched with the Levenshtein automaton of a word."""

    def __init__(self, terms: dict[str, int]) -> None:
        """``terms``: number of edits that each term allows."""
        self.terms = [t.encode() for t in terms]
        self.allowed = np.array(list(terms.values()), dtype=np.int64)
        self.root = TrieNode()
        for number, (term, most) in enumerate(zip(self.terms, terms.values(), strict=True)):
            node = self.root
            node.most = max(node.most, most)
            for byte in term:
                node = node.children.setdefault(byte, TrieNode())
                node.most = max(node.most, most)
            node.term = number
        self.masks = np.array(
            [np.bitwise_or.reduce(_LETTER_BIT[np.frombuffer(t, np.uint8)]) for t in self.terms], dtype=np.uint64
        )
        self.lengths = np.array([len(t) for t in self.terms], dtype=np.int64)
        self.found: dict[int, int] = {}
        self.joined: dict[bytes, int] = {}

    def hits(self, word: bytes) -> list[tuple[int, int]]:
        """Distance and place of every term that allows the distance to ``word``.

        The automaton's state at a trie node is the row of distances between the node's path and every prefix of the
        word, cut off above the distance allowed below the node.
        """
        found = []
        stack = [(self.root, list(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            if node.term >= 0 and row[-1] <= self.allowed[node.term]:
                found.append((row[-1], node.term))
            for byte, child in node.children.items():
                new = [row[0] + 1]
                for k, own in enumerate(word):
                    new.append(min(new[k] + 1, row[k + 1] + 1, row[k] + (own != byte)))
                if min(new) <= child.most:
                    stack.append((child, new))
        return found

    def distance(self, word: bytes) -> int:
        """Least distance to a term that allows it, or -1."""
        return min((far for far, _ in self.hits(word)), default=-1)

    def near(self, masks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Words that may be within the distance of a term: each edit changes the length by one at most and the set of
        letters by two."""
        out = np.zeros(len(masks), dtype=bool)
        for mask, length, allowed in zip(self.masks, self.lengths, self.allowed, strict=True):
            differ = np.bitwise_count(masks ^ mask)
            out |= (np.abs(lengths - length) <= allowed) & (differ <= 2 * allowed)
        return out

    def distances(self, piece, words) -> np.ndarray:
        """Distance (or -1) of every word of the piece."""
        if not len(words.codes) or not self.terms:
            return np.full(len(words.codes), -1)
        if len(self.found) > REMEMBERED:
            self.found = {}
        codes, first, inverse = np.unique(words.codes, return_index=True, return_inverse=True)
        lengths = words.lengths[first]
        masks = np.empty(len(codes), np.uint64)
        for low, high, places, heads in word_bytes(words.starts[first], lengths):
            masks[low:high] = np.bitwise_or.reduceat(_LETTER_BIT[piece.data[places]], heads)
        out = np.full(len(codes), -1)
        for k in np.flatnonzero(self.near(masks, lengths)).tolist():
            code = int(codes[k])
            if code not in self.found:
                start = words.starts[first[k]]
                self.found[code] = self.distance(LOWER[piece.data[start : start + lengths[k]]].tobytes())
            out[k] = self.found[code]
        return out[inverse]


def joined_runs(piece, words, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """First words of the runs of ``parts`` words with signs but no blank between them, up to ``longest`` bytes in all."""
    if len(words.starts) < 2:
        return
    ends = words.starts + words.lengths
    blanks = np.concatenate([[0], np.cumsum(SPACE[piece.data])])
    linked = blanks[words.starts[1:]] == blanks[ends[:-1]]
    heads = words.bounds[1:-1]
    linked[heads[(heads > 0) & (heads < len(words.starts))] - 1] = False
    size = np.concatenate([[0], np.cumsum(words.lengths)])
    at, parts = np.flatnonzero(linked), 2
    while len(at):
        at = at[size[at + parts] - size[at] <= longest]
        yield parts, at
        at = at[at + parts - 1 < len(linked)]
        at = at[linked[at + parts - 1]]
        parts += 1


def joined_word(piece, words, first: int, parts: int) -> bytes:
    spans = zip(words.starts[first : first + parts], words.lengths[first : first + parts], strict=True)
    return b"".join(LOWER[piece.data[start : start + length]].tobytes() for start, length in spans)


def joined_hits(piece, words, far: np.ndarray, lexicon: Lexicon) -> list[tuple[int, int, int]]:
    """First word, number of words and distance of joined runs that hit a term; none shares a word with another hit."""
    if not lexicon.terms:
        return []
    found = []
    for parts, at in joined_runs(piece, words, int((lexicon.lengths + lexicon.allowed).max())):
        at = at[np.all([far[at + k] < 0 for k in range(parts)], axis=0)]
        lengths = np.sum([words.lengths[at + k] for k in range(parts)], axis=0)
        for first in at[lengths >= max(1, int((lexicon.lengths - lexicon.allowed).min()))].tolist():
            word = joined_word(piece, words, first, parts)
            if word not in lexicon.joined:
                if len(lexicon.joined) > REMEMBERED:
                    lexicon.joined = {}
                data = np.frombuffer(word, np.uint8)
                mask = np.array([np.bitwise_or.reduce(_LETTER_BIT[data])])
                near = lexicon.near(mask, np.array([len(word)]))[0]
                lexicon.joined[word] = lexicon.distance(word) if near else -1
            if lexicon.joined[word] >= 0:
                found.append((lexicon.joined[word], -parts, first))
    out, taken = [], set()
    for distance, parts, first in sorted(found):
        own = set(range(first, first - parts))
        if not own & taken:
            taken |= own
            out.append((first, -parts, distance))
    return sorted(out)


def context_factor(before: bytes, behind: bytes) -> float:
    """How much a hit counts, from the bytes on both sides of it."""
    near = before.lower().replace(b"'", b"") + b" " + behind.lower().replace(b"'", b"")
    words = set(near.translate(_BLANKED).split())
    opened = max(before.rfind(mark) for mark in _OPENING)
    # An even number of plain marks before the hit means that the last one closes.
    plain_closed = opened >= 0 and before[opened : opened + 1] == b'"' and before.count(b'"') % 2 == 0
    quoted = opened >= 0 and not plain_closed and any(mark in behind for mark in _CLOSING)
    factor = QUOTED if quoted or words & REPORTING else 1.0
    return factor * (ADDRESSED if words & ADDRESSING else 1.0)


_BLANKED = bytes(0x20 if _BETWEEN[b] else b for b in range(256))


def _features(column: pa.Array, lexicon: Lexicon) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows of a piece and their features: sum of the hits, cut at one and damped, and hits per word."""
    for piece in text_pieces(column):
        words = byte_words(piece, between=_BETWEEN)
        far = lexicon.distances(piece, words)
        rows = piece.last - piece.first
        sums = np.zeros(rows)
        hits = [(k, 1, int(far[k])) for k in np.flatnonzero(far >= 0).tolist()]
        for k, parts, distance in hits + joined_hits(piece, words, far, lexicon):
            start, end = int(words.starts[k]), int(words.starts[k + parts - 1] + words.lengths[k + parts - 1])
            row = int(np.searchsorted(words.bounds, k, side="right")) - 1
            low, high = int(piece.offsets[row]), int(piece.offsets[row + 1])
            before = piece.data[max(low, start - CONTEXT_BYTES) : start].tobytes()
            behind = piece.data[end : min(high, end + CONTEXT_BYTES)].tobytes()
            sums[row] += context_factor(before, behind) * (1 if distance == 0 else MISSPELLED)
        count = np.diff(words.bounds)
        out = np.stack(
            [
                np.minimum(sums, 1),
                np.log1p(sums),
                np.log1p(100 * sums / np.maximum(count, 1)),
            ],
            axis=1,
        )
        yield piece.first, piece.last, out


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [], []
        for piece in text_pieces(batch.column(0)):
            words = byte_words(piece, between=_BETWEEN)
            data = LOWER[piece.data]
            joined = [set() for _ in range(piece.last - piece.first)]
            for parts, at in joined_runs(piece, words, JOINED_BYTES):
                for row, k in zip((np.searchsorted(words.bounds, at, side="right") - 1).tolist(), at.tolist(), strict=True):
                    joined[row].add(joined_word(piece, words, k, parts).decode("utf-8", "ignore"))
            for row, (first, last) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
                _, at = np.unique(words.codes[first:last], return_index=True)
                own = joined[row]
                for k in at + first:
                    own.add(data[words.starts[k] : words.starts[k] + words.lengths[k]].tobytes().decode("utf-8", "ignore"))
                rows += [piece.first + row] * len(own)
                found += own
        labels = batch.column(1).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([labels, pa.array(found, pa.string())], ["toxic", "word"])


def learn_terms(sample: DataFrame) -> dict[str, int]:
    """Words of the sample (text, toxic) with a confidently high share of toxic texts, and the edits that each allows.

    A term whose neighbours within its edits are words of clean texts allows none.
    """
    words = sample.mapInArrow(_distinct_words, "toxic int, word string")
    counts = stored(words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("all")), "toxicity-words")
    share, n, z = F.col("bad") / F.col("all"), F.col("all"), CONFIDENCE_Z
    middle = share + z * z / (2 * n)
    spread = z * F.sqrt((share * (1 - share) + z * z / (4 * n)) / n)
    low = (middle - spread) / (1 + z * z / n)
    chosen = counts.where((F.col("bad") >= LEAST_TEXTS) & (low >= LEAST_SHARE) & (F.length("word") >= 3))
    # Each takes LEAST_TEXTS of the sample's texts at least.
    chosen = chosen.orderBy(F.desc("bad"), "word").collect()
    own = {r["word"]: r["all"] for r in chosen}
    terms = {word: edits_allowed(word.encode()) for word in sorted(own)}
    names = list(terms)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            column = batch.column(0)
            for piece in text_pieces(column):
                data = [piece.data[a:b] for a, b in zip(piece.offsets[:-1], piece.offsets[1:], strict=True)]
                masks = np.array([np.bitwise_or.reduce(_LETTER_BIT[d]) for d in data], dtype=np.uint64)
                places, clean = [], []
                for k in np.flatnonzero(lexicon.near(masks, np.diff(piece.offsets))).tolist():
                    for far, place in lexicon.hits(data[k].tobytes()):
                        if far:
                            places.append(place)
                            clean.append(batch.column(1)[piece.first + k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places, pa.int32()), pa.array(clean, pa.int64())], ["term", "clean"]
                )

    if names:
        clean = counts.select("word", (F.col("all") - F.col("bad")).alias("clean")).where("clean > 0")
        near = clean.mapInArrow(neighbours, "term int, clean long").groupBy("term").agg(F.sum("clean").alias("clean"))
        for row in near.collect():
            if row["clean"] > CLEAN_NEIGHBOURS * own[names[row["term"]]]:
                terms[names[row["term"]]] = 0
    return terms


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, penalty: float = 0.1) -> np.ndarray:
    """Weights (last: constant) of a penalised logistic regression by Newton steps; weights of hits are not negative."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    w[:-1] = 0.5
    ridge = np.full(len(w), penalty)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        w[:-1] = np.maximum(w[:-1], 0)
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    terms: dict[str, int]
    weights: np.ndarray


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit to ``labels`` (doc_id, toxic); null ids and labels are left out, of several labels the largest counts.

    Without labels no text is toxic.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # At most SAMPLE rows of two numbers.
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic").dropDuplicates()
    sample = stored(sample, "toxicity-sample")
    terms = learn_terms(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            for first, last, x in _features(batch.column(0), lexicon):
                columns = [pa.array(np.ascontiguousarray(x[:, k])) for k in range(FEATURES)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, batch.column(1).slice(first, last - first)], [*names, "toxic"]
                )

    names = [f"x{k}" for k in range(FEATURES)]
    rows = sample.mapInArrow(run, ", ".join(f"{n} double" for n in names) + ", toxic int").toArrow().to_pandas()
    if not len(rows):
        return ToxicityModel({}, np.array([0.0] * FEATURES + [-math.log(99)]))
    rows = rows.sort_values([*names, "toxic"])
    return ToxicityModel(terms, fit_logistic(rows[names].to_numpy(), rows["toxic"].to_numpy(float)))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with a column toxicity (0 to 1) from each whole text; null and empty texts have no hits.

    Rows and other columns stay as they are, repeated ones too; a column of that name is replaced.
    """
    kept = [c for c in docs.columns if c != "toxicity"]
    names = [f"c{k}" for k in range(len(kept))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)])
    text = names[kept.index("text")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields) + ", toxicity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            for first, last, x in _features(batch.column(text), lexicon):
                value = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value)], [*names, "toxicity"])

    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], "toxicity")


def labelled_rows(spark: SparkSession, sf_dir: str, folds: int = 5) -> DataFrame:
    """Labels outside fold 0, which are the only ones learned from."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), folds) != 0)


def score_corpus(spark: SparkSession, sf_dir: str, folds: int = 5) -> DataFrame:
    """Score of every document: doc_id, held_out, score, predicted."""
    docs = documents(spark, sf_dir)
    model = train(docs.select("doc_id", "text"), labelled_rows(spark, sf_dir, folds))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
