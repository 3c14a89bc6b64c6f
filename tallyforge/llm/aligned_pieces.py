"""SentencePiece BPE with the place of every piece in the original bytes.

A text is normalised first: at each place the longest key of the model's compiled character map is replaced (a map
without keys copies), blanks become U+2581 and one stands before the text. Each byte of the result knows the byte of the
original at which its character, or the replaced key, begins. Merging then runs over the normalised text, and the ends
of the pieces are read off that alignment, so spans are bytes of the original however the text was changed.

No piece has U+2581 behind another character, so the normalised text falls into segments that merge apart; new
segments of a group of texts are merged together and kept in a bounded cache of the task. Models with byte fallback are
supported: a character without a piece gives its bytes, the last of which holds its span.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from struct import pack
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.corpus import small_batches

MODEL = "piece_bpe_32k.model"
MOST_SEGMENTS = 300_000
# Segments above this many characters are merged with a heap and not kept.
LONGEST_KEPT = 64
# Characters of a text that are normalised and merged at once; cut before a blank only.
SLICE = 1 << 20

BLANK = "▁"
NO_RANK = 1 << 28
NO_MERGE = NO_RANK << 32
# Key of a free place in the table of pairs; that of two characters without a piece is -1.
FREE = -2
# Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

codecs.register_error("each-byte", lambda e: ("�", e.start + 1))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharMap:
    """Keys and replacements of a compiled map: a double-array trie over UTF-8 bytes, then the replacements.

    Of a unit of the array, bits 0-7 and 31 are the label, bit 8 says that a key ends, bits 9-30 are the offset to the
    children; the child with label 0 of such a unit holds the place of the replacement.
    """

    def __init__(self, compiled: bytes) -> None:
        self.rules: dict[str, str] = {}
        if compiled:
            size = int.from_bytes(compiled[:4], "little")
            self._read(np.frombuffer(compiled, "<u4", size // 4, 4).astype(np.int64), compiled[4 + size :])
        self.by_first: dict[str, list[tuple[str, str]]] = {}
        for key in sorted(self.rules, key=len, reverse=True):
            self.by_first.setdefault(key[0], []).append((key, self.rules[key]))
        starts = "".join(map(re.escape, self.by_first))
        self.start = re.compile(f"[{starts}]") if starts else None
        # Whether a text may be cut before a blank behind printable ASCII without a change of what either part gives.
        self.cuts_at_blank = not any(" " in key or "!" <= key[-1] <= "~" for key in self.rules)

    def _read(self, units: np.ndarray, replacements: bytes) -> None:
        labels = np.arange(1, 256)
        children = lambda at: at ^ ((units[at] >> 10) << ((units[at] & 512) >> 6))
        nodes, keys = np.array([0]), [b""]
        while len(nodes):
            bases = children(nodes)
            for k in np.flatnonzero((units[nodes] >> 8) & 1):
                begin = int(units[bases[k]] & 0x7FFFFFFF)
                new = replacements[begin : replacements.index(b"\0", begin)].decode()
                if "  " in new:
                    raise ValueError("a replacement with two blanks in a row is not supported")
                self.rules[keys[k].decode()] = new
            below = bases[:, None] ^ labels
            inside = below < len(units)
            row, col = np.nonzero(inside & ((units[np.where(inside, below, 0)] & 0x800000FF) == labels))
            nodes, keys = below[row, col], [keys[r] + bytes([c + 1]) for r, c in zip(row, col, strict=True)]

    def apply(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Parts of the normalised text, with the bytes of the replaced key, or None where the text is copied."""
        if self.start is None:
            yield text, None
            return
        copied = at = 0
        while (found := self.start.search(text, at)) is not None:
            at = found.start()
            key, new = next(((k, v) for k, v in self.by_first[text[at]] if text.startswith(k, at)), ("", ""))
            if not key:
                at += 1
                continue
            if copied < at:
                yield text[copied:at], None
            yield new, len(key.encode())
            copied = at = at + len(key)
        if copied < len(text):
            yield text[copied:], None


class Encoded(NamedTuple):
    """Ids of a text, and first byte and byte after the last of each in the original."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class PieceBpe:
    """Encoder and decoder of one model file."""

    def __init__(self, model: bytes) -> None:
        pieces, compiled = [], b""
        self.dummy_prefix, self.remove_extra, escape, fallback = True, True, True, False
        for number, value in _fields(model):
            if number == 1:
                part = dict(_fields(value))
                score = float(np.frombuffer(part.get(2, b"\0\0\0\0"), "<f4")[0])
                pieces.append((part[1].decode(), score, part.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                fallback = bool(spec.get(35, 0))
                if spec.get(3, 1) != 2 or spec.get(24, 0):
                    raise ValueError("only BPE models with blanks before words are supported")
            elif number == 3:
                spec = dict(_fields(value))
                compiled = spec.get(2, b"")
                self.dummy_prefix, self.remove_extra = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                escape = bool(spec.get(5, 1))
        if not (fallback and escape) or any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
            raise ValueError("models without byte fallback, or with user-defined or unused pieces, are not supported")
        self.map = CharMap(compiled)
        self.ids = {piece: k for k, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        order = {s: k for k, s in enumerate(sorted({s for _, s, kind in pieces if kind == NORMAL}, reverse=True))}
        self.rank = {piece: order[score] for piece, score, kind in pieces if kind == NORMAL}
        self.byte_ids = {int(piece[3:5], 16): k for k, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        kinds = np.array([kind for _, _, kind in pieces])
        self.begin_id = next((k for k, p in enumerate(pieces) if p[0] == "<s>" and p[2] == CONTROL), None)
        self.end_id = next((k for k, p in enumerate(pieces) if p[0] == "</s>" and p[2] == CONTROL), None)
        self.byte_piece, self.control, self.normal = kinds == BYTE, kinds == CONTROL, set(self.ids.values())
        self.surface = [piece.replace(BLANK, " ").encode() for piece, _, _ in pieces]
        for k, (piece, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.surface[k] = bytes([int(piece[3:5], 16)])
            elif kind == CONTROL:
                self.surface[k] = b""
            elif kind == UNKNOWN:
                self.surface[k] = " ⁇ ".encode()
        # A segment is a run of blanks and what follows up to the next one, or the whole text where a piece spans both.
        spans = any(BLANK in piece.lstrip(BLANK) for piece in self.ids)
        self.segment = re.compile(".+" if spans else f"{BLANK}*[^{BLANK}]+|{BLANK}+", re.DOTALL)
        self.sliced = self.map.cuts_at_blank and not self.remove_extra and not spans
        self.kept = _Segments(self._merged)
        self.symbol_of = np.full(0x110000, -1, np.int64)
        for piece, number in self.ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = number
        self._pair_table()

    def normalise(self, text: str, first: bool = True) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the byte of ``text`` where its source begins.

        ``first``: the text begins here, so that a blank is put before it.
        """
        new: list[bytes] = []
        origins: list[np.ndarray] = []
        at = 0
        for part, replaced in self.map.apply(text):
            data = part.encode()
            new.append(data)
            if replaced is None:
                place = np.arange(at, at + len(data), dtype=np.uint32)
                inner = np.frombuffer(data, np.uint8) & 0xC0 == 0x80
                origins.append(np.maximum.accumulate(np.where(inner, np.uint32(at), place)))
                at += len(data)
            else:
                origins.append(np.full(len(data), at, np.uint32))
                at += replaced
        mapped, end = b"".join(new), at
        origin = np.concatenate(origins) if origins else np.empty(0, np.uint32)
        blank = np.frombuffer(mapped, np.uint8) == 0x20
        if self.remove_extra:
            stays = ~(blank & np.concatenate([[True], blank[:-1]])[: len(blank)])
            places = np.flatnonzero(stays)
            if len(places) and blank[places[-1]]:
                end, places = int(origin[places[-1]]), places[:-1]
            mapped, origin, blank = np.frombuffer(mapped, np.uint8)[places].tobytes(), origin[places], blank[places]
        if not mapped:
            return "", np.array([end], np.uint32)
        origin = np.repeat(origin, np.where(blank, len(BLANK.encode()), 1))
        normalised = mapped.decode().replace(" ", BLANK)
        if first and self.dummy_prefix:
            normalised = BLANK + normalised
            origin = np.concatenate([np.full(len(BLANK.encode()), origin[0]), origin])
        return normalised, np.append(origin, np.uint32(end))

    def _parts(self, segment: str) -> list[str]:
        """Merge the neighbours that make the best piece, the left one of equals, until none make a piece."""
        parts, rank = list(segment), self.rank
        if len(parts) > LONGEST_KEPT:
            return self._parts_of_long(parts)
        ranks = [rank.get(a + b, NO_MERGE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_MERGE:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get(parts[k - 1] + parts[k], NO_MERGE)
            if k < len(ranks):
                ranks[k] = rank.get(parts[k] + parts[k + 1], NO_MERGE)
        return parts

    def _parts_of_long(self, parts: list[str]) -> list[str]:
        """The same with a heap of the pairs and links between the parts that are left."""
        rank, last = self.rank, len(parts)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        heap: list[tuple[int, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < last:
                joined = parts[left] + parts[after[left]]
                if joined in rank:
                    heapq.heappush(heap, (rank[joined], left, joined))

        for left in range(last - 1):
            offer(left)
        while heap:
            _, left, joined = heapq.heappop(heap)
            right = after[left]
            # A pair is stale when either part has grown or is gone.
            if not parts[left] or right >= last or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[left] < last:
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [part for part in parts if part]

    def _merged(self, segment: str) -> bytes:
        """Id and length in normalised bytes of each piece of a segment, as pairs of 32-bit integers.

        Of the bytes of a character without a piece, the last has its whole length and the others none.
        """
        pairs: list[int] = []
        for part in self._parts(segment):
            data = part.encode()
            number = self.ids.get(part)
            if number is None:
                for byte in data[:-1]:
                    pairs += [self.byte_ids[byte], 0]
                number = self.byte_ids[data[-1]]
            pairs += [number, len(data)]
        return pack(f"<{len(pairs)}I", *pairs)

    def _learn(self, segments: set[str]) -> None:
        """Merge the segments that are new, all at once, and keep them.

        Each round merges the best pair of every segment that has one: flat arrays hold the symbols, links to the
        neighbours, and for each pair its rank and place as one number, of which a segment's least is its next merge.
        """
        if len(self.kept) > MOST_SEGMENTS:
            self.kept.clear()
        new = [s for s in segments.difference(self.kept) if len(s) <= LONGEST_KEPT]
        if not new:
            return
        points = np.frombuffer("".join(new).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        starts = np.cumsum(sizes) - sizes
        symbol = self.symbol_of[points]
        odd = np.logical_or.reduceat(symbol < 0, starts)
        count = len(points)
        # One more place behind the last, which no pair reaches.
        after = np.arange(1, count + 1)
        after[starts + sizes - 1] = count
        before = np.arange(-1, count - 1)
        before[starts] = count
        symbol = np.append(symbol, -1)
        after, before = np.append(after, count), np.append(before, count)
        alive = np.ones(count, bool)

        def keys(places: np.ndarray) -> np.ndarray:
            rank = self._pair(symbol[places], symbol[after[places]])[1]
            return np.where(rank < NO_RANK, rank << 32 | places, NO_MERGE)

        key = keys(np.arange(count))
        open_starts, open_sizes = starts, sizes
        where = np.arange(count)
        while True:
            best = np.minimum.reduceat(key[where], open_starts)
            going = best < NO_MERGE
            if not going.any():
                break
            left = best[going] & 0xFFFFFFFF
            right = after[left]
            symbol[left] = self._pair(symbol[left], symbol[right])[0]
            alive[right] = False
            key[right] = NO_MERGE
            after[left] = after[right]
            inner = after[left] < count
            before[after[left[inner]]] = left[inner]
            key[left] = keys(left)
            front = before[left]
            front = front[front < count]
            key[front] = keys(front)
            # What is left: the places that still count, of the segments that still merge.
            stays = alive[where] & np.repeat(going, open_sizes)
            open_sizes = np.add.reduceat(stays, open_starts)[going]
            where = where[stays]
            open_starts = np.cumsum(open_sizes) - open_sizes
        places = np.flatnonzero(alive)
        widths = np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        ends = widths[np.append(places[1:], count) - 1]
        pairs = np.empty((len(places), 2), "<u4")
        pairs[:, 0] = symbol[places]
        pairs[:, 1] = np.diff(ends, prepend=0)
        packed = pairs.tobytes()
        bounds = (np.append(np.searchsorted(places, starts), len(places)) * 8).tolist()
        kept = self.kept
        for k, segment in enumerate(new):
            kept[segment] = self._merged(segment) if odd[k] else packed[bounds[k] : bounds[k + 1]]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and rank of the pieces that pairs of symbols make; the rank is NO_RANK where they make none."""
        wanted = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        slot = (wanted * _SPREAD) >> self.pair_shift & self.pair_mask
        found = np.full(len(wanted), -1)
        at = np.arange(len(wanted))
        while len(at):
            held = self.pair_keys[slot]
            hit = held == wanted[at]
            found[at[hit]] = slot[hit]
            more = ~hit & (held != FREE)
            at, slot = at[more], slot[more] + 1 & self.pair_mask
        none = found < 0
        return np.where(none, -1, self.pair_symbol[found]), np.where(none, NO_RANK, self.pair_rank[found])

    def _pair_table(self) -> None:
        """A table of every two pieces that make a piece, by open addressing with one place in four taken at most."""
        rows = []
        for piece, number in self.ids.items():
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    rows.append((left << 32 | right, number, self.rank[piece]))
        bits = max(4, (4 * len(rows)).bit_length())
        self.pair_shift, self.pair_mask = 64 - bits, (1 << bits) - 1
        size = 1 << bits
        self.pair_keys = np.full(size, FREE, np.int64)
        self.pair_symbol, self.pair_rank = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if rows:
            slots = np.array([key for key, _, _ in rows], np.int64) * _SPREAD >> self.pair_shift & self.pair_mask
            for (key, number, rank), slot in zip(rows, slots.tolist(), strict=True):
                while self.pair_keys[slot] != FREE:
                    slot = slot + 1 & self.pair_mask
                self.pair_keys[slot], self.pair_symbol[slot], self.pair_rank[slot] = key, number, rank

    def _slices(self, text: str) -> Iterator[str]:
        at = 0
        while self.sliced and len(text) - at > SLICE:
            cut = _CUT.search(text, at + SLICE)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _prepared(self, part: str, first: bool) -> tuple[list[str], np.ndarray]:
        normalised, origin = self.normalise(part, first)
        return self.segment.findall(normalised), origin

    def _placed(self, segments: list[str], origin: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of segments, and their spans projected to the original."""
        pairs = np.frombuffer(b"".join(map(self.kept.__getitem__, segments)), "<u4").reshape(-1, 2)
        ends = np.cumsum(pairs[:, 1], dtype=np.int64)
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])[: len(ends)]
        return pairs[:, 0], origin[starts].astype(np.int64) + offset, origin[ends].astype(np.int64) + offset

    def encode_many(self, texts: list[str], begin: bool = True, end: bool = True) -> Iterator[Encoded]:
        """Ids and spans of whole texts, with the ids of begin and end where asked for.

        New segments of all texts of up to a slice are merged together; a longer text goes slice by slice.
        """
        ready = [self._prepared(text, True) if len(text) <= SLICE else None for text in texts]
        self._learn(set().union(*[pair[0] for pair in ready if pair]))
        for text, pair in zip(texts, ready, strict=True):
            size = len(text) if text.isascii() else len(text.encode())
            found = [self._placed(*pair, 0)] if pair else list(self._long(text))
            edges = [np.array([place] if on else [], np.int64) for on, place in ((begin, 0), (end, size))]
            marks = [np.array([n] if on else [], "<u4") for on, n in ((begin, self.begin_id), (end, self.end_id))]
            yield Encoded(
                np.concatenate([marks[0], *[f[0] for f in found], marks[1]]),
                np.concatenate([edges[0], *[f[1] for f in found], edges[1]]),
                np.concatenate([edges[0], *[f[2] for f in found], edges[1]]),
            )

    def _long(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        offset = 0
        for part in self._slices(text):
            segments, origin = self._prepared(part, first=not offset)
            self._learn(set(segments))
            yield self._placed(segments, origin, offset)
            offset += len(part.encode())

    def encode(self, text: str, begin: bool = True, end: bool = True) -> Encoded:
        return next(self.encode_many([text], begin, end))

    def decode(self, ids: list[int]) -> str:
        """The text of the pieces; control ids have none, and the blank that was put before a text goes.

        Each byte that is not UTF-8 gives one U+FFFD.
        """
        texts = list(map(self.surface.__getitem__, ids))
        if self.dummy_prefix or self.remove_extra:
            for k, number in enumerate(ids):
                if self.control[number]:
                    continue
                if self.byte_piece[number] or not texts[k].startswith(b" ") or number not in self.normal:
                    break
                texts[k] = texts[k].lstrip(b" ") if self.remove_extra else texts[k][1:]
                if texts[k] or not self.remove_extra:
                    break
        return b"".join(texts).decode("utf-8", errors="each-byte")


_CUT = re.compile("(?<=[!-~]) ")
_SPREAD = np.int64(-7046029254386353131)


class _Segments(dict):
    """Merged segments by their text; one that is not kept is merged by itself."""

    def __init__(self, merge) -> None:
        super().__init__()
        self.merge = merge

    def __missing__(self, segment: str) -> bytes:
        return self.merge(segment)


@lru_cache(maxsize=2)
def codec(model: str) -> PieceBpe:
    """The codec of a file name of the public tokenizers, or of a path; one for each Python worker."""
    with open(model if "/" in model else public_tokenizers.path(model), "rb") as file:
        return PieceBpe(file.read())


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in groups of about a slice; null counts as empty."""
    group, size = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size >= SLICE:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(
    df: DataFrame,
    text_column: str = "text",
    prefix: str = "piece",
    model: str = MODEL,
    begin: bool = True,
    end: bool = True,
) -> DataFrame:
    """``df`` with ``{prefix}_ids``, ``{prefix}_begins`` and ``{prefix}_ends`` of each whole text.

    Begins and ends are bytes of the text in UTF-8; begin and end ids stand on nothing at either edge. A null or empty
    text has no pieces but begin and end ids. All other columns and rows stay as they are, repeated ones too; columns
    of the three names are replaced.
    """
    names = [f"{prefix}_{part}" for part in ("ids", "begins", "ends")]
    kept = [c for c in df.columns if c not in names]
    inner = [f"c{k}" for k in range(len(kept))]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(kept, inner, strict=True)]
    plain = df.select(*columns, F.col(f"`{text_column}`").cast("string").alias("x"))
    lists = [T.StructField(f"y{k}", T.ArrayType(T.IntegerType() if k == 0 else T.LongType())) for k in range(3)]
    schema = T.StructType([*[T.StructField(n, plain.schema[n].dataType) for n in inner], *lists])
    kinds = [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            start = 0
            for group in _groups(batch.column("x")):
                rows = list(own.encode_many(group, begin, end))
                part = batch.slice(start, len(rows))
                start += len(rows)
                made = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in inner], *made], [*inner, "y0", "y1", "y2"])

    small_batches(df.sparkSession)
    out = plain.mapInArrow(run, schema)
    back = [F.col(n).alias(c) for c, n in zip(kept, inner, strict=True)]
    return out.select(*back, *[F.col(f"y{k}").alias(n) for k, n in enumerate(names)])


def decode(
    df: DataFrame, ids_column: str = "piece_ids", text_column: str = "decoded", model: str = MODEL
) -> DataFrame:
    """``df`` with the text of each list of ids; null counts as an empty list, an id outside the model is an error.

    A column named ``text_column`` is replaced.
    """
    kept = [c for c in df.columns if c != text_column]
    inner = [f"c{k}" for k in range(len(kept))]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(kept, inner, strict=True)]
    plain = df.select(*columns, F.col(f"`{ids_column}`").alias("x"))
    schema = T.StructType(
        [*[T.StructField(n, plain.schema[n].dataType) for n in inner], T.StructField("y", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = pa.array([own.decode(ids.as_py() or []) for ids in part.column("x")], pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in inner], texts], [*inner, "y"])

    small_batches(df.sparkSession)
    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(kept, inner, strict=True)], F.col("y").alias(text_column))


def encoded_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids and of the text decoded from them, and the bytes that the spans cover.

    The same as ``encode`` followed by ``decode``, in one pass that sends no ids. One row for each row of ``docs``,
    repeated ones too; null and empty texts have begin and end ids only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            counts, of_ids, of_texts, covered = [], [], [], []
            for group in _groups(batch.column(1)):
                for ids, begins, ends in own.encode_many(group):
                    counts.append(len(ids))
                    of_ids.append(sha256(ids.tobytes()).hexdigest())
                    of_texts.append(sha256(own.decode(ids.tolist()).encode()).hexdigest())
                    covered.append(int((ends - begins).sum()))
            columns = [pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_texts), pa.array(covered, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"]
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long"
    return rows.mapInArrow(run, schema)
