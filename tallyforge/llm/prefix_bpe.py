"""Byte-level BPE by the last token of every prefix, shared in a trie.

The encoding of a prefix is fixed by its last token and the encoding of what stands before that token. So each node of
a trie of words needs one state, its last token: the one token that ends there and may stand behind the last token of
the node where it begins. Two tokens may stand side by side when merging their joined bytes gives the same two tokens;
this is read off the merges that built them, undone from the last one on: none of the parts that meet at the seam may
merge before the merges that made them.
The trie is that of the sorted distinct new words of a group of texts. A node is a prefix and stands at the first word
that has it; the words that share it follow. States are propagated level by level with numpy for all nodes of a level,
so a prefix shared by many words is encoded once. The state is first guessed from the state above and the byte, as met
before, and kept if the pair of tokens is known to fit; what is left is decided one by one.

Tries and memos belong to a task and are bounded; full memos are started anew.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain
from typing import Any

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.corpus import PIECE_BYTES, small_batches

TOKENIZER = "byte_bpe_50k.json"
MOST_NODES, MOST_SEGMENTS, MOST_PAIRS = 400_000, 250_000, 300_000
# Words above this many bytes are walked outside the trie.
LONGEST_KEPT = 48

# Letters and numbers that came after Unicode 16, the version of the tokenizers library; marks to it and here.
_NEWER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD-\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EEE\U00011B0A\U00011DB0-\U00011DF1\U0001246F-\U0001247F"
    r"\U00012550-\U00012686\U00016EA0-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA"
    r"\U00018D09-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DFFF"
    r"\U0001E6C0-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U0003FC3F"
)
_TWO_BLANKS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
# Letters up to U+00FF behind a blank or none, and at most one mark: what the split pattern surely cuts between these two.
_WORD = re.compile("( ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([.,;:]?)")


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in the vocabulary file: itself where printable, else the next from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Slots:
    """Values of 64-bit keys by arrays, one key to a slot; a later key takes the place of an earlier one."""

    def __init__(self, most: int) -> None:
        self.shift = np.uint64(64 - most.bit_length())
        self.keys = np.full(1 << most.bit_length(), np.iinfo(np.int64).min)
        self.values = np.zeros(len(self.keys), np.int32)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it is not known."""
        at = self._at(keys)
        return np.where(self.keys[at] == keys, self.values[at], -1)

    def put(self, keys: list[int], values: list[int]) -> None:
        keys = np.array(keys, np.int64)
        at = self._at(keys)
        self.keys[at], self.values[at] = keys, values


class PrefixBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {as_bytes(token): number for token, number in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(as_bytes(a), as_bytes(b)): rank for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {number: token for token, number in self.ids.items()}
        self.bytes_of |= {number: text.encode() for text, number in self.special.items()}
        self.decimal = {number: str(number) for number in self.bytes_of}
        known = re.sub(r"\\p\{[LN]\}", lambda kind: f"[{kind[0]}--[{_NEWER}]]", public_tokenizers.PATTERN)
        self.split = regex.compile(known, regex.V1)
        self.plain = r"| ?\p{L}+|" in public_tokenizers.PATTERN
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.length = {number: len(token) for token, number in self.ids.items()} | {-1: 0}
        self.longest = max(self.length.values())
        # Rank of the merge of two tokens; of a token: rank of the merge that makes it (a byte: -1) and its two parts.
        self.seam = {self.ids[a] << 32 | self.ids[b]: rank for (a, b), rank in self.ranks.items()}
        self.made = dict.fromkeys(self.length, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        for (a, b), rank in self.ranks.items():
            token = self.ids[a + b]
            self.made[token], self.parts[token] = rank, (self.ids[a], self.ids[b])
        # With several ways to make a token its parts depend on what stands around.
        self.one_way = len(self.parts) == len(self.ranks)
        self.pairs: dict[int, bool] = {}
        # Bytes of each token; the last cell is that of -1, the start.
        self.sizes = np.zeros(max(self.bytes_of) + 2, np.int64)
        for number, size in self.length.items():
            self.sizes[number] = size
        # Token met before behind a last token and a byte; pairs that fit.
        self.steps, self.fits = _Slots(MOST_PAIRS), _Slots(MOST_PAIRS)
        self.segments: dict[str, tuple[int, ...]] = {}
        self.shown: dict[str, tuple[str, bytes]] = {}

    def _merged(self, text: bytes) -> list[bytes]:
        """Merge by rank until nothing is left to merge; only for two joined tokens."""
        parts = [text[k : k + 1] for k in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand behind ``left`` (-1: at the start)."""
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            own = self.bytes_of[right]
            if left < 0:
                found = self._merged(own) == [own]
            elif self.one_way and self._may_follow(-1, left) and self._may_follow(-1, right):
                found = self._seam_holds(left, right)
            else:
                found = self._merged(self.bytes_of[left] + own) == [self.bytes_of[left], own]
            self.pairs[key] = found
        return found

    def _seam_holds(self, left: int, right: int) -> bool:
        """Whether no merge across the seam of two tokens comes before the merges beside it; equal ranks merge leftmost first."""
        seam, made, parts = self.seam, self.made, self.parts
        limit = 1 << 60
        while True:
            if seam.get(left << 32 | right, limit) < limit:
                return False
            a, b = made[left], made[right]
            if a > b:
                limit, left = a, parts[left][1]
            elif b >= 0:
                limit, right = b + 1, parts[right][0]
            else:
                return True

    def _state(self, word: bytes, end: int, last: list[int]) -> tuple[int, int]:
        """Last token of ``word[:end]`` and its length; ``last`` has the last tokens of the shorter prefixes.

        Just one token fits, so the order of trial is free: the token before grown by a byte, then short ones first.
        """
        ids, pairs = self.ids, self.pairs
        guess = self.length[last[end - 1]] + 1
        token = ids.get(word[end - guess : end])
        if token is not None:
            left = last[end - guess]
            fits = pairs.get(left << 32 | token)
            if fits or fits is None and self._may_follow(left, token):
                return token, guess
        for size in range(1, min(end, self.longest) + 1):
            token = ids.get(word[end - size : end])
            if token is not None:
                left = last[end - size]
                fits = pairs.get(left << 32 | token)
                if fits or fits is None and self._may_follow(left, token):
                    return token, size
        raise ValueError("the vocabulary has no token for a byte")

    def _propagate(self, words: list[bytes]) -> np.ndarray:
        """Last tokens of the prefixes of sorted distinct words: a row for each length from 0, a column for each word."""
        count = len(words)
        lengths = np.fromiter(map(len, words), np.int64, count)
        depth = int(lengths.max())
        letters = np.array(words, f"S{depth}").view(np.uint8).reshape(count, depth)
        # Bytes that a word shares with the word before; its further prefixes are new nodes.
        shared = np.zeros(count, np.int64)
        same = letters[1:] == letters[:-1]
        shared[1:] = np.minimum(np.where(same.all(1), depth, same.argmin(1)), np.minimum(lengths[1:], lengths[:-1]))
        letters = letters.T.astype(np.int64)
        last = np.full((depth + 1, count), -1, np.int64)
        rows = np.arange(count)
        for end in range(1, depth + 1):
            rows = rows[lengths[rows] >= end]
            new = shared[rows] < end
            nodes = rows[new]
            before = last[end - 1, nodes]
            steps = before << 8 | letters[end - 1, nodes]
            tokens = self.steps.get(steps)
            sizes = self.sizes[tokens]
            # The last token and the byte tell the bytes of a token no longer than both.
            told = (tokens >= 0) & (sizes <= self.sizes[before] + 1)
            sizes[~told] = 0
            left = last[end - sizes, nodes]
            fits = told & (self.fits.get(left << 32 | tokens) > 0)
            open_steps, found, pairs = [], [], []
            for k in np.flatnonzero(~fits).tolist():
                states, token, size = last[:end, nodes[k]].tolist(), int(tokens[k]), int(sizes[k])
                if not (told[k] and self._may_follow(states[end - size], token)):
                    token, size = self._state(words[nodes[k]], end, states)
                    tokens[k] = token
                open_steps.append(steps[k])
                found.append(token)
                pairs.append(states[end - size] << 32 | token)
            if found:
                self.steps.put(open_steps, found)
                self.fits.put(pairs, [1] * len(pairs))
            last[end, rows] = tokens[np.cumsum(new) - 1]
        return last

    def _ids_of_words(self, words: list[bytes]) -> Iterator[list[int]]:
        """Ids of each of some sorted distinct words, through tries of at most ``MOST_NODES`` nodes."""
        step = max(1, MOST_NODES // max(map(len, words), default=1))
        for first in range(0, len(words), step):
            part = words[first : first + step]
            last = self._propagate(part)
            ends = np.fromiter(map(len, part), np.int64, len(part))
            counts = np.zeros(len(part), np.int64)
            rows, columns = np.arange(len(part)), []
            while len(rows):
                tokens = last[ends[rows], rows]
                columns.append((rows, tokens))
                counts[rows] += 1
                ends[rows] -= self.sizes[tokens]
                rows = rows[ends[rows] > 0]
            bounds = np.cumsum(counts)
            ids = np.empty(bounds[-1], np.int64)
            for k, (rows, tokens) in enumerate(columns):
                ids[bounds[rows] - 1 - k] = tokens
            ids, begin = ids.tolist(), 0
            for end in bounds.tolist():
                yield ids[begin:end]
                begin = end

    def _ids_of_long(self, word: bytes) -> list[int]:
        last, sizes = [-1], [0]
        for end in range(1, len(word) + 1):
            token, size = self._state(word, end, last)
            last.append(token)
            sizes.append(size)
        out, end = [], len(word)
        while end:
            out.append(last[end])
            end -= sizes[end]
        return out[::-1]

    def _cut(self, text: str) -> list[str]:
        """Cut before single blanks between words, where the split pattern always begins anew."""
        if _TWO_BLANKS.search(text):
            return _CUT.split(text)
        parts = text.split(" ")
        return [parts[0], *[" " + part for part in parts[1:]]] if parts[0] else [" " + part for part in parts[1:]]

    def _learn(
        self, memo: dict[str, Any], rows: list[list[str]], form: Callable[[list[int]], Any], join: Callable[[Iterable], Any]
    ) -> None:
        """Put into ``memo`` what its rows of segments lack: ``form`` of the ids of a word, ``join`` of the forms of several."""
        if not memo or len(memo) > MOST_SEGMENTS:
            memo.clear()
            # A text's ordinary segments never hold the string of a special token.
            memo.update({text: form([number]) for text, number in self.special.items()})
        plain = _WORD.fullmatch if self.plain else lambda segment: None
        words, several = set(), {}
        for segment in set().union(*rows).difference(memo):
            found = plain(segment)
            parts = [part for part in found.groups() if part] if found else self.split.findall(segment)
            if len(parts) == 1:
                words.add(segment)
            else:
                several[segment] = parts
        # In order of code points, which is that of the bytes.
        words = sorted(words.union(*several.values()).difference(memo))
        in_bytes = [word.encode() for word in words]
        short = self._ids_of_words([word for word in in_bytes if len(word) <= LONGEST_KEPT])
        for word, own in zip(words, in_bytes, strict=True):
            memo[word] = form(next(short) if len(own) <= LONGEST_KEPT else self._ids_of_long(own))
        for segment, parts in several.items():
            memo[segment] = join([memo[part] for part in parts])

    def _rows(self, texts: list[str]) -> list[list[str]]:
        """The segments of each text."""
        rows: list[list[str]] = []
        for text in texts:
            if any(content in text for content in self.special):
                row: list[str] = []
                for part in self.cut_special.split(text):
                    row.extend([part] if part in self.special else self._cut(part))
                rows.append(row)
            else:
                rows.append(self._cut(text))
        return rows

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        rows = self._rows(texts)
        # Tuples of numbers are soon left alone by the collection of cycles.
        self._learn(self.segments, rows, tuple, lambda parts: tuple(chain.from_iterable(parts)))
        return [list(chain.from_iterable(map(self.segments.__getitem__, row))) for row in rows]

    def shown_batch(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Of each text the comma-joined ids and the bytes that they decode to, both kept by segment."""
        rows = self._rows(texts)
        self._learn(self.shown, rows, self._show, _join_shown)
        for row in rows:
            yield _join_shown(map(self.shown.__getitem__, row))

    def _show(self, ids: list[int]) -> tuple[str, bytes]:
        return ",".join(map(self.decimal.__getitem__, ids)), b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


def _join_shown(parts: Iterable[tuple[str, bytes]]) -> tuple[str, bytes]:
    ids, own = tuple(zip(*parts, strict=True)) or ((), ())
    return ",".join(ids), b"".join(own)


@lru_cache(maxsize=2)
def codec(tokenizer: str) -> PrefixBpe:
    """The codec of a file name of the public tokenizers, or of a path; one for each Python worker."""
    return PrefixBpe(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))


def _groups(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in groups of about a piece's size; null counts as empty."""
    group, size = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size >= PIECE_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _map_column(df: DataFrame, source: str, target: str, kind: T.DataType, change) -> DataFrame:
    """Add ``target`` (in place of a column of that name) computed from ``source`` batch by batch."""
    kept = [c for c in df.columns if c != target]
    names = [f"c{k}" for k in range(len(kept))]
    plain = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)], F.col(f"`{source}`").alias("x"))
    schema = T.StructType([*[T.StructField(n, plain.schema[n].dataType) for n in names], T.StructField("y", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for values in change(batch.column("x")):
                part = batch.slice(start, len(values))
                start += len(values)
                columns = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, values], [*names, "y"])

    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], F.col("y").alias(target))


def encode(
    df: DataFrame, text_column: str = "text", ids_column: str = "ids", tokenizer: str = TOKENIZER
) -> DataFrame:
    """``df`` with the token ids of each whole text; null and empty texts have none.

    The string of a special token gives its id, no other special token is added. All other columns and rows stay as
    they are, repeated ones too; a column named ``ids_column`` is replaced.
    """

    def change(texts: pa.Array) -> Iterator[pa.Array]:
        for group in _groups(texts):
            yield pa.array(codec(tokenizer).encode_batch(group), pa.list_(pa.int32()))

    return _map_column(df, text_column, ids_column, T.ArrayType(T.IntegerType()), change)


def decode(
    df: DataFrame, ids_column: str = "ids", text_column: str = "decoded", tokenizer: str = TOKENIZER
) -> DataFrame:
    """``df`` with the text of each list of ids, special tokens included; null counts as an empty list.

    Bytes that are not UTF-8 become U+FFFD; an id outside the vocabulary is an error.
    """

    def change(column: pa.Array) -> Iterator[pa.Array]:
        for start in range(0, len(column), 256):
            rows = column.slice(start, 256).to_pylist()
            yield pa.array([codec(tokenizer).decode(ids or []) for ids in rows], pa.string())

    return _map_column(df, ids_column, text_column, T.StringType(), change)


def _digest(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    own = codec(tokenizer)
    for batch in batches:
        start = 0
        for group in _groups(batch.column(1)):
            counts, of_ids, of_texts = [], [], []
            for ids, decoded in own.shown_batch(group):
                counts.append(ids.count(",") + 1 if ids else 0)
                of_ids.append(sha256(ids.encode()).hexdigest())
                of_texts.append(sha256(decoded.decode("utf-8", errors="replace").encode()).hexdigest())
            columns = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(group)), *columns], DIGEST_NAMES)
            start += len(group)


DIGEST_NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def encoded_digests(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the comma-joined ids and of the text decoded from them.

    The same as ``encode`` followed by ``decode``, in one pass that sends no ids. Null and empty texts have no ids and the
    digests of the empty string; repeated rows give repeated rows, an empty table none; a null id stays null; other columns
    are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(lambda batches: _digest(batches, tokenizer), schema)
