"""Repair of conversations with the cheapest edits, as a stream of rows sorted by conversation and turn.

One shuffle brings a conversation's rows to one task, sorted by turn; ``mapInPandas`` walks over them and carries the
state of a dynamic program from batch to batch. Its states are the ends that a repaired conversation may have so far;
each has the cost of the cheapest edits that lead there and the rank of their letters among those of the other states,
which is enough to find the least of all cheapest edit strings without holding any string. A row leaves one integer of
back-pointers.

A conversation that fits a block is traced back and written where it was read. Of a longer one, only the back-pointers
of a block at a time are held: they go out as rows, a second stream reads them from the last block to the first and
turns them into edits, and a third applies these to the conversation's rows, again in turn order. So no task holds more
than a block of any conversation.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.corpus import small_batches, stored

BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 23
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
RESULT, BLOCK, SUMMARY = range(3)
LEGAL = {"su", "ua", "au"}

# States: nothing yet, behind the system row, behind a user's row, behind an assistant's row.
START, SYSTEM, USER, ASSISTANT = range(4)
# Role that stands next, and the state behind it.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
# Inserts that end a conversation.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
# Edits up to and with that of a row; the place in this list is the code of a back-pointer.
STEPS = ("D", "K", "R", "IK", "IR", "IIK", "IIR")
COST = {"D": 3, "K": 0, "R": 2, "I": 2}

Vector = tuple[tuple[int, int] | None, ...]
BEGIN: Vector = ((0, 0), None, None, None)


def _moves(initial: str, deleted: bool, state: int) -> Iterator[tuple[str, int]]:
    """Edits that a row allows from a state, with the state behind them."""
    yield "D", state
    if deleted:
        return
    for inserts in ("", "I", "II"):
        following = NEXT[state][1]
        if initial == "s" and state == START and not inserts:
            yield "K", SYSTEM
        elif initial == ("a" if following == ASSISTANT else "u"):
            yield inserts + "K", following
        yield inserts + "R", following
        state = following


@lru_cache(maxsize=None)
def step(vector: Vector, initial: str, fault: int) -> tuple[Vector, int, int]:
    """The states behind a row, with costs above the least of them, that least cost, and the back-pointers.

    Five bits of the back-pointers for each state: the state before (two) and the code of the edits. No string of edits
    up to a row begins another one, as each ends with the row's own edit; so strings that differ before the row are
    ordered by rank, and others by the row's edits.
    """
    best: dict[int, tuple[int, int, str, int]] = {}
    for state, reached in enumerate(vector):
        if reached is None:
            continue
        for edits, behind in _moves(initial, fault in (BLANK, DUPLICATE), state):
            cost = reached[0] + sum(map(COST.__getitem__, edits)) + (fault == TRUNCATED and edits != "D")
            candidate = (cost, reached[1], edits, state)
            if behind not in best or candidate < best[behind]:
                best[behind] = candidate
    least = min(cost for cost, *_ in best.values())
    ranks = {entry: k for k, entry in enumerate(sorted((rank, edits) for _, rank, edits, _ in best.values()))}
    after, pointers = [], 0
    for state in range(4):
        found = best.get(state)
        after.append(found and (found[0] - least, ranks[found[1], found[2]]))
        if found:
            pointers |= (found[3] | STEPS.index(found[2]) << 2) << 5 * state
    return tuple(after), least, pointers


def finish(vector: Vector) -> tuple[int, int]:
    """Cost of closing the conversation, and the state to close from, for the cheapest and then least edits."""
    ends = [
        (cost + sum(map(COST.__getitem__, CLOSING[state])), rank, state)
        for state, (cost, rank) in ((s, v) for s, v in enumerate(vector) if v is not None)
    ]
    cost, _, state = min(ends)
    return cost, state


def trace(pointers: array, state: int) -> tuple[list[str], int]:
    """Edits of each row of a block that ends in ``state``, and the state before the block."""
    out = []
    for row in reversed(pointers):
        own = row >> 5 * state
        out.append(STEPS[own >> 2 & 7])
        state = own & 3
    return out[::-1], state


class Writer:
    """Applies edits to rows and hashes what comes out."""

    def __init__(self) -> None:
        self.state, self.lines, self.hash, self.audit = START, 0, sha256(), []

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def apply(self, edits: str, role: str = "", text: str = "") -> None:
        self.audit.append(edits)
        for edit in edits:
            if edit == "D":
                continue
            wanted, behind = NEXT[self.state]
            if edit == "K":
                self._line(role, text)
                behind = SYSTEM if role[:1] == "s" else behind
            else:
                self._line(wanted, text if edit == "R" else "")
            self.state = behind


class Conversation:
    """Counts and program of the rows of one conversation as they come."""

    def __init__(self, key: str) -> None:
        self.key, self.rows, self.first, self.chars = key, [], 0, 0
        self.pointers, self.vector, self.cost = array("I"), BEGIN, 0
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.low = self.high = None
        self.turns = 0

    def add(self, has_turn: bool, turn: int, role: str, text: str, fault: int) -> None:
        if has_turn:
            if self.high is None or turn != self.high:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.faults[fault] += 1
        self.vector, cost, pointers = step(self.vector, initial if initial in ("s", "u", "a") else "", fault)
        self.cost += cost
        self.pointers.append(pointers)
        self.rows.append((role, text))
        self.chars += len(text)

    def full(self, rows: int) -> bool:
        return len(self.rows) >= rows or self.chars >= BLOCK_CHARS

    def spill(self) -> tuple:
        """A row with the back-pointers held so far; rows and pointers are given up."""
        out = (self.key, BLOCK, self.first, self.pointers.tobytes(), 0, *[0] * 6, "", "")
        self.first += len(self.rows)
        self.rows, self.chars, self.pointers = [], 0, array("I")
        return out

    def end(self) -> Iterator[tuple]:
        closing, state = finish(self.vector)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = (gaps, *self.faults[1:], self.illegal, self.cost + closing)
        if self.first:
            if self.rows:
                yield self.spill()
            yield (self.key, SUMMARY, self.first, b"", state, *counts, "", "")
            return
        writer = Writer()
        for edits, (role, text) in zip(trace(self.pointers, state)[0], self.rows, strict=True):
            writer.apply(edits, role, text)
        writer.apply(CLOSING[state])
        yield (self.key, RESULT, 0, b"", state, *counts, "".join(writer.audit), writer.hash.hexdigest())


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_NAMES = ["key", "kind", "number", "pointers", "state", *COUNTS, "audit", "repaired_sha256"]
_SCHEMA = (
    "key string, kind int, number long, pointers binary, state int, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", audit string, repaired_sha256 string"
)


def _forward(frames: Iterator[pd.DataFrame], block_rows: int) -> Iterator[pd.DataFrame]:
    """Results of short conversations; back-pointers by block, and then counts and last state, of the others."""
    own: Conversation | None = None
    for frame in frames:
        out: list[tuple] = []
        for key, gone, has_turn, turn, role, text, fault in frame.itertuples(index=False, name=None):
            if own is None or key != own.key:
                if own is not None:
                    out.extend(own.end())
                own = Conversation(key)
            if gone:
                continue
            if own.full(block_rows):
                out.append(own.spill())
            own.add(has_turn, turn, role, text, fault)
        yield pd.DataFrame(out, columns=_NAMES)
    if own is not None:
        yield pd.DataFrame(list(own.end()), columns=_NAMES)


def _backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of each block as text between commas; a conversation's last state comes first, then its last block."""
    state = START
    for frame in frames:
        out = []
        for key, kind, number, pointers, last in frame.itertuples(index=False, name=None):
            if kind == SUMMARY:
                state = last
                out.append((key, number, CLOSING[state]))
            else:
                edits, state = trace(array("I", pointers), state)
                out.append((key, number, ",".join(edits)))
        yield pd.DataFrame(out, columns=["key", "number", "edits"])


def _rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit and hash of conversations whose edits come block by block, each before the rows that it is for."""
    key, writer, edits, out = None, None, iter(()), []
    names = ["key", "audit", "repaired_sha256"]
    for frame in frames:
        for own, block, role, text in frame.itertuples(index=False, name=None):
            if own != key:
                if writer:
                    out.append((key, "".join(writer.audit), writer.hash.hexdigest()))
                key, writer = own, Writer()
            if block is None:
                writer.apply(next(edits), role, text)
            else:
                closing = set(block) <= {"I"}
                edits = iter(() if closing else block.split(","))
                if closing:
                    writer.apply(block)
        yield pd.DataFrame(out, columns=names)
        out = []
    if writer:
        yield pd.DataFrame([(key, "".join(writer.audit), writer.hash.hexdigest())], columns=names)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults by the crc32 of conversation and turn, and ``gone``.

    Null roles and texts are one blank; so are a null id and turn in the checksum. ``gone`` marks dropped rows, which
    stay for the sake of conversations that lose all.
    """
    blank = F.lit(" ")
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("long").cast("string"), blank) for c in ("conv_id", "turn")])
    code = F.crc32(name.cast("binary")) % 20
    damaged = F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        damaged.alias("text"),
        (code == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _faults(earlier: Column) -> Column:
    text = F.col("text")
    return (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(earlier, DUPLICATE)
        .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
        .otherwise(NO_FAULT)
    )


def _plain(rows: DataFrame, gone_column: str | None) -> DataFrame:
    blank = F.lit(" ")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), blank).alias("key"),
        (F.col(f"`{gone_column}`") if gone_column else F.lit(False)).alias("gone"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )


_ORDER = ["turn", "role", "text"]


def repair(rows: DataFrame, gone_column: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each conversation of ``rows``: its counts of faults, and the cheapest repair.

    ``rows`` has conv_id, turn, role and text; rows where ``gone_column`` is true only name their conversation, other
    columns are not read. A conversation's rows stand by turn (null first), those of one turn by role and text; a null role or text
    is one blank, and rows with a null id are one conversation. A conversation without rows has zeros, no edits, and the
    hash of the empty text; an empty table gives no rows.
    """
    small_batches(rows.sparkSession)
    plain = _plain(rows, gone_column)
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    # The window and the stream both use the one shuffle by conversation.
    seen = Window.partitionBy("key", "gone", "same").orderBy("turn")
    dealt = plain.repartition("key").withColumn("same", same).withColumn("nth", F.row_number().over(seen))
    stream = dealt.sortWithinPartitions("key", *_ORDER).select(
        "key", "gone", F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),
        "role", "text", _faults(F.col("nth") > 1).alias("fault"),
    )
    found = stored(stream.mapInPandas(lambda frames: _forward(frames, block_rows), _SCHEMA), "conversations")
    results = found.where(F.col("kind") == RESULT).select("key", *COUNTS, "audit", "repaired_sha256")
    long = found.where(F.col("kind") == SUMMARY)
    if not long.isEmpty():
        results = results.unionByName(_long_results(plain, found.where(F.col("kind") != RESULT), long))
    conv_id = F.when(F.col("key") != " ", F.col("key").cast("long")).alias("conv_id")
    return results.select(conv_id, *COUNTS, "audit", "repaired_sha256")


def _long_results(plain: DataFrame, blocks: DataFrame, long: DataFrame) -> DataFrame:
    """The second and third stream, for conversations of more than a block."""
    back = blocks.select("key", "kind", "number", "pointers", "state").repartition("key")
    back = back.sortWithinPartitions("key", F.desc("number"), F.desc("kind"))
    edits = back.mapInPandas(_backward, "key string, number long, edits string")
    place = F.row_number().over(Window.partitionBy("key").orderBy(*_ORDER)) - 1
    rows = plain.where(~F.col("gone")).join(long.select("key"), "key", "left_semi")
    rows = rows.select("key", place.cast("long").alias("number"), F.lit(None).cast("string").alias("edits"), "role", "text")
    nothing = F.lit("")
    both = rows.union(edits.select("key", "number", "edits", nothing, nothing)).repartition("key")
    # A block of edits comes before its first row, and the closing edits behind the last.
    both = both.sortWithinPartitions("key", "number", F.col("edits").isNull()).select("key", "edits", "role", "text")
    written = both.mapInPandas(_rewrite, "key string, audit string, repaired_sha256 string")
    return long.select("key", *COUNTS).join(written, "key")


def repaired_damage(rows: DataFrame) -> DataFrame:
    """The repair of ``rows`` after ``damage``."""
    return repair(damage(rows), "gone")
