"""Shared helpers: pieces of Arrow text columns, words as 64-bit codes, folds, stored tables.

Texts are handled as the bytes of the Arrow column, so that splitting and hashing of words is numpy work
without a Python object for each word. Code tables are seeded constants: equal words have equal codes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import scratch_path

# Bytes of text that a task turns into arrays at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20
# Words whose bytes are spread into wider numbers at once, so that a long text takes little more than its own bytes.
BLOCK_WORDS = 1 << 15
# Rows of an Arrow batch; Spark's own default is ten times as many, which long texts and pairs of sets make too large.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)[LOWER]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64
)
_powers = np.cumprod(np.full(1 << 10, _STEP, dtype=np.uint64))


class Piece(NamedTuple):
    """Some rows of a batch: first row, row after the last, bytes of their texts, offsets of each text."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def text_pieces(texts: pa.Array | pa.ChunkedArray, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of an Arrow column in pieces of at most ``limit`` bytes or one row; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        begin, end = offsets[first], offsets[last]
        yield Piece(first, last, data[begin:end], offsets[first : last + 1] - begin)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, so that their order says nothing about the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(length: int) -> np.ndarray:
    global _powers
    if length > len(_powers):
        _powers = np.cumprod(np.full(1 << int(length - 1).bit_length(), _STEP, dtype=np.uint64))
    return _powers


class Words(NamedTuple):
    """Words of a piece in text order: code, first byte, length; ``bounds`` cuts them into texts."""

    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray


def word_bytes(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of words: first word, word after the last, places of their bytes, and where each word begins in these."""
    for first in range(0, len(starts), BLOCK_WORDS):
        last = min(first + BLOCK_WORDS, len(starts))
        size = lengths[first:last]
        heads = np.cumsum(size) - size
        yield first, last, np.repeat(starts[first:last] - heads, size) + np.arange(size.sum()), heads


def byte_words(piece: Piece, longest: int | None = None, between: np.ndarray = SPACE) -> Words:
    """Runs of bytes other than those of ``between`` (blank and 0x09-0x0D), coded with A-Z in lower case.

    With ``longest``, a longer run is cut into words of that many bytes.
    """
    data, offsets = piece.data, piece.offsets
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    solid = ~between[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    filled = offsets[1:] > offsets[:-1]
    firsts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[firsts] |= solid[firsts]
    ends[lasts] |= solid[lasts]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    if longest is not None and len(lengths) and lengths.max() > longest:
        parts = -(-lengths // longest)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        tail = np.repeat(starts + lengths, parts)
        starts = np.repeat(starts, parts) + step * longest
        lengths = np.minimum(tail - starts, longest)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.empty(0, np.uint64), starts, lengths, bounds)
    powers = _power_table(int(lengths.max()))
    codes = np.empty(len(starts), np.uint64)
    for first, last, places, heads in word_bytes(starts, lengths):
        size = lengths[first:last]
        at = np.arange(len(places)) - np.repeat(heads, size)
        values = _BYTE_CODES[data[places]] * powers[at]
        codes[first:last] = mix(np.add.reduceat(values, heads) + size.astype(np.uint64))
    return Words(codes, starts, lengths, bounds)


def window_codes(codes: np.ndarray, span: int) -> np.ndarray:
    """One code for each run of ``span`` codes, in order."""
    count = max(0, len(codes) - span + 1)
    out = np.full(count, np.uint64(span), dtype=np.uint64)
    for k in range(span):
        out = mix(out * _MULTIPLIERS[k % 4] + codes[k : k + count])
    return out


def shingle_sets(piece: Piece, width: int) -> list[np.ndarray]:
    """Sorted distinct codes of the runs of ``width`` words of each text.

    A text with fewer words has its whole sequence as the one shingle; a text without words has none.
    """
    found = byte_words(piece)
    runs = window_codes(found.codes, width)
    out = []
    for first, last in zip(found.bounds[:-1], found.bounds[1:], strict=True):
        if last - first >= width:
            out.append(np.unique(runs[first : last - width + 1]))
        else:
            out.append(window_codes(found.codes[first:last], int(last - first)) if last > first else runs[:0])
    return out


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def small_batches(spark: SparkSession) -> None:
    """Rows with texts or sets go to Python at most ``BATCH_ROWS`` at a time, unless the session asks for fewer."""
    if int(spark.conf.get(_BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends here."""
    small_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
