"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, the other words lose their case, punctuation goes. Runs of ``SPAN``
template tokens are the windows; one with too few literal words keeps its exact values. Windows of documents and benchmark items meet in a hash join;
before it, windows that no item has are dropped in the task by a fixed-size bit set. For each document and item, on each
alignment, the values behind equal placeholders are compared: a re-parameterised question replaces each value by one
other throughout, so every value of the item must go with one value of the document.

A capitalised word that opens a sentence may be a name or not, and a copy may stand in other letters or behind other words.
So names are read three ways on both sides: as the text has them, openings as names too, and no name at all. Openings of
both sides are not exchanged for each other, or any two questions would begin alike.

A document is contaminated by an item if it has at least half of the item's windows, or of those with enough literal words,
or a long run of them, and the slots are consistent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.corpus import Piece, byte_words, mix, stored, text_pieces, window_codes

SPAN, MOST_SLOTS = 8, 3
LEAST_COVERAGE, LONG_RUN, LEAST_CONSISTENT = 0.5, 20, 0.8
# Bits of the set that drops windows before the join.
FILTER_BITS = 1 << 23
# Words that count as numbers and as units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
)
UNIT_WORDS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces"
    " pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week"
    " weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres mph kmh dollar"
    " dollars cent cents euro euros usd eur percent degree degrees"
)

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(0x80, 0x100)]] = False
_DIGIT, _UPPER, _LOWERCASE, _STOP = (np.zeros(256, dtype=bool) for _ in range(4))
_DIGIT[[*b"0123456789"]] = True
_UPPER[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_LOWERCASE[[*b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True
_STOP[[*b".!?\n:\""]] = True
# Codes of the placeholders.
NUMBER, NAME, UNIT = (np.uint64(k) for k in (11, 12, 13))
# Marks of keys: templates, templates for documents whose openings are names, exact values.
PLAIN, OPENED, EXACT = (np.uint64(k) for k in (0, 1 << 20, 1 << 21))


def _codes_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return np.sort(byte_words(Piece(0, 1, data, np.array([0, len(data)])), between=_BETWEEN).codes)


_NUMBER_CODES, _UNIT_CODES = _codes_of(NUMBER_WORDS), _codes_of(UNIT_WORDS)


def canonical(piece: Piece) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Template codes and slot marks of the tokens of a piece, original codes, and bounds of the texts.

    Templates and marks are given for names as written, with openings as names, and without names.
    """
    data = piece.data.copy()
    if len(data) > 2:
        # Points and commas between digits belong to the number; Latin capitals of two bytes lose their case.
        inner = np.flatnonzero(_DIGIT[data[:-2]] & _DIGIT[data[2:]] & ((data[1:-1] == 0x2E) | (data[1:-1] == 0x2C))) + 1
        data[inner] = ord("0")
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
    data[capital] += 0x20
    found = byte_words(Piece(piece.first, piece.last, data, piece.offsets), between=_BETWEEN)
    codes, starts = found.codes, found.starts
    if not len(codes):
        return [(codes, np.empty(0, bool))] * 3, codes, found.bounds
    ends = starts + found.lengths
    stops = np.concatenate([[0], np.cumsum(_STOP[piece.data])])
    opening = np.zeros(len(codes), dtype=bool)
    opening[1:] = stops[starts[1:]] > stops[ends[:-1]]
    heads = found.bounds[:-1]
    opening[heads[heads < len(codes)]] = True
    number = _DIGIT[data[starts]] | np.isin(codes, _NUMBER_CODES)
    unit = np.isin(codes, _UNIT_CODES)
    second = _LOWERCASE[data[np.minimum(starts + 1, len(data) - 1)]] & (found.lengths > 1)
    capital = _UPPER[data[starts]] & second & ~number & ~unit
    readings = []
    for name in (capital & ~opening, capital, np.zeros(len(codes), dtype=bool)):
        template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, codes)))
        readings.append((template, number | unit | name))
    return readings, codes, found.bounds


def _windows(spans: list[int], keep: np.ndarray | None, of_items: bool):
    """Rows (id, position, key, slots, span, dense) of the windows of each text; ``keep``: bit set of the wanted keys.

    Items have keys that their documents may have; a window of an item with too many slots is dense and has an exact key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch.column(1)):
                readings, codes, bounds = canonical(piece)
                owners = np.repeat(np.arange(piece.last - piece.first), np.diff(bounds))
                written, named, plain = readings
                filled = np.concatenate([[0], np.cumsum(written[1])])
                none = np.zeros(len(codes), dtype=bool)
                if of_items:
                    ways = [(written, PLAIN), (written, OPENED), (named, PLAIN), (plain, PLAIN)]
                else:
                    ways = [(written, PLAIN), (named, OPENED), (plain, PLAIN)]
                ways.append(((codes, none), EXACT))
                for span in spans:
                    count = len(codes) - span + 1
                    if count <= 0:
                        continue
                    inside = owners[span - 1 :] == owners[:count]
                    dense = filled[span:] - filled[:count] > min(MOST_SLOTS, span // 2)
                    if of_items and span < SPAN:
                        inside &= np.diff(bounds)[owners[:count]] == span
                    first = None
                    for (template, slot), mark in ways:
                        keys = mix(window_codes(template, span) + np.uint64(span) + mark)
                        usable = inside.copy()
                        if of_items:
                            # An opening read as a name may be one slot more, but not most of the window.
                            held = np.concatenate([[0], np.cumsum(slot)])
                            usable &= (dense == (mark == EXACT)) & (held[span:] - held[:count] <= span // 2)
                        if keep is not None:
                            usable &= keep[(keys % np.uint64(FILTER_BITS)).astype(np.int64)]
                        if first is None:
                            first = keys
                        else:
                            usable &= keys != first
                        at = np.flatnonzero(usable)
                        slots = [codes[p : p + span][slot[p : p + span]].view(np.int64).tolist() for p in at.tolist()]
                        row = owners[at]
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array(piece.first + row)),
                                pa.array(at - bounds[row], pa.int32()),
                                pa.array(keys[at].view(np.int64)),
                                pa.array(slots, pa.list_(pa.int64())),
                                pa.array(np.full(len(at), span), pa.int32()),
                                pa.array(dense[at]),
                            ],
                            ["id", "position", "key", "slots", "span", "dense"],
                        )

    return run


_SCHEMA = "id long, position int, key long, slots array<long>, span int, dense boolean"


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, windows, coverage, consistency) of every document that an item contaminates.

    Null or empty texts match nothing; an item shorter than a window is one window, also of one word or of slots alone. Windows
    with more than ``MOST_SLOTS`` slots, or half of a short one, are found only with equal values. coverage is the share of
    all windows or of the others, whichever is greater. A copy with other names is not found by a window in which both an
    opening of the item and an opening of the document stand for names elsewhere.
    Rows without id cannot be named and are left out; rows that repeat an id count as one document. An empty table on
    either side gives no row; columns other than ids and text are not read.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text").where("id IS NOT NULL")
    asked = stored(items.mapInArrow(_windows(list(range(1, SPAN + 1)), None, True), _SCHEMA), "template-items")
    spans = sorted(r["span"] for r in asked.select("span").distinct().collect())
    asked = asked.select(
        F.col("id").alias("item_id"), F.col("position").alias("item_position"), "key", F.col("slots").alias("item_slots"),
        "dense",
    )
    # At most FILTER_BITS numbers.
    bits = asked.select((F.pmod(F.col("key"), F.lit(FILTER_BITS))).cast("int").alias("b")).distinct().toArrow().to_pandas()["b"]
    keep = np.zeros(FILTER_BITS, dtype=bool)
    keep[bits.to_numpy(np.int64)] = True
    literal = F.when(~F.col("dense"), F.col("item_position"))
    totals = asked.groupBy("item_id").agg(
        F.countDistinct("item_position").alias("windows"), F.countDistinct(literal).alias("literal_windows")
    )

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id IS NOT NULL")
    met = rows.mapInArrow(_windows(spans, keep, False), _SCHEMA).drop("span", "dense")
    met = met.join(asked, "key").withColumn("shift", F.col("position") - F.col("item_position"))
    slots = F.filter(F.arrays_zip("item_slots", "slots"), lambda pair: pair["item_slots"].isNotNull())
    lines = met.groupBy("id", "item_id", "shift").agg(
        F.collect_set("item_position").alias("positions"),
        F.collect_set(literal).alias("literal"),
        F.array_distinct(F.flatten(F.collect_set(slots))).alias("pairs")
    )
    values = F.size(F.array_distinct(F.col("pairs.item_slots")))
    lines = lines.withColumn("consistent", F.when(F.size("pairs") > 0, values / F.size("pairs")).otherwise(1.0))
    both = lines.groupBy("id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("matched"),
        F.size(F.array_distinct(F.flatten(F.collect_list("literal")))).alias("literal"),
        (F.sum(F.col("consistent") * F.size("positions")) / F.sum(F.size("positions"))).alias("consistency"),
    )
    both = both.join(totals, "item_id")
    # Of an item whose windows are all dense the second share is null, and greatest() passes over it.
    shares = F.col("matched") / F.col("windows"), F.try_divide("literal", "literal_windows")
    both = both.withColumn("coverage", F.greatest(*shares))
    enough = (F.col("coverage") >= LEAST_COVERAGE) | (F.col("matched") >= LONG_RUN)
    return both.where(enough & (F.col("consistency") >= LEAST_CONSISTENT)).select(
        F.col("id").alias("doc_id"), "item_id", "matched", "windows", "coverage", "consistency"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates; rows without id stay."""
    found = contaminated_pairs(docs, benchmark).select("doc_id").distinct()
    return docs.join(stored(found, "template-found"), "doc_id", "left_anti")
