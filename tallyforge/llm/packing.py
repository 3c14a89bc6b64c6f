"""Token ids packed into rows of one length by best-fit decreasing.

Each task tokenises its texts, cuts overlong ones into parts of a row's length without loss, and packs pools of at most
``POOL_TOKENS`` tokens: parts by falling length, each into the fullest row that has room, found by descending a segment
tree over the free capacities. A row carries its ids, the cumulative lengths of its segments and positions that start
anew with each segment. There is no shuffle: a lost executor costs its own splits, memory is that of one pool, and no key
or source matters for the layout.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
LENGTH, POOL_TOKENS = 2048, 1 << 21
SCHEMA = (
    "input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, parts array<int>, n_tokens int"
)


class CapacityTree:
    """Which free capacities some row has: a segment tree over 1..length with a stack of rows at each leaf."""

    def __init__(self, length: int) -> None:
        self.size = 1 << length.bit_length()
        self.counts = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, row: int, free: int) -> None:
        if free:
            self.rows[free].append(row)
            self._add(free, 1)

    def _add(self, free: int, change: int) -> None:
        node = free + self.size
        while node:
            self.counts[node] += change
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Row with the least free capacity of at least ``need``, taken out, and that capacity."""
        node = need + self.size
        if not self.counts[node]:
            # Climb to the first right neighbour that holds a row, then descend to its left-most leaf.
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        free = node - self.size
        self._add(free, -1)
        return self.rows[free].pop(), free


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Places of the parts in each row; sizes are 1 to ``length``. Equal sizes keep their order."""
    rows: list[list[int]] = []
    tree = CapacityTree(length)
    for place in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        found = tree.take(sizes[place])
        if found is None:
            rows.append([])
            found = len(rows) - 1, length
        row, free = found
        rows[row].append(place)
        tree.put(row, free - sizes[place])
    return rows


@lru_cache(maxsize=2)
def encoding(vocabulary: str) -> tuple[tiktoken.Encoding, int]:
    """Encoder of a rank file (name of a public tokenizer, or path) and the free id that ends a document."""
    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own, max(ranks.values()) + 1


def _rows(pool: list[tuple[int | None, int, np.ndarray]], length: int, filler: int) -> pa.RecordBatch:
    packed = best_fit_decreasing([len(ids) for _, _, ids in pool], length)
    columns: list[list] = [[] for _ in range(6)]
    for places in packed:
        lengths = np.array([len(pool[k][2]) for k in places], dtype=np.int32)
        ends = np.cumsum(lengths, dtype=np.int32)
        ids = np.full(length, filler, dtype="<i4")
        ids[: ends[-1]] = np.concatenate([pool[k][2] for k in places])
        positions = np.zeros(length, dtype="<i4")
        positions[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        row = (ids.tobytes(), positions.tobytes(), [0, *ends.tolist()], [pool[k][0] for k in places],
               [pool[k][1] for k in places], int(ends[-1]))
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    kinds = [pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32()]
    names = ["input_ids", "position_ids", "cu_seqlens", "doc_ids", "parts", "n_tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    vocabulary: str = VOCABULARY,
    pool_tokens: int = POOL_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Packed rows of the ids of all texts, each text followed by the end id; see ``SCHEMA``.

    ``input_ids`` and ``position_ids`` are ``length`` little-endian 32-bit numbers, filled up with the end id and zeros
    behind ``n_tokens``; stacked in any order they are the id matrix. Segment k of a row is part ``parts[k]`` of document
    ``doc_ids[k]``; joining a document's parts gives its ids back. A null or empty text is its end id alone; a null id
    stays null; repeated rows are packed each; an empty table gives no row. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoding(vocabulary)
        pool: list[tuple[int | None, int, np.ndarray]] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encoder.encode_ordinary(text.as_py() or ""), end], dtype=np.int32)
                for part, start in enumerate(range(0, len(ids), length)):
                    piece = ids[start : start + length]
                    if pool and held + len(piece) > pool_tokens:
                        yield _rows(pool, length, end)
                        pool, held = [], 0
                    pool.append((doc_id, part, piece))
                    held += len(piece)
        if pool:
            yield _rows(pool, length, end)

    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the rows as Parquet: the id matrix, positions and segment bounds row by row."""
    packed.write.parquet(path)
