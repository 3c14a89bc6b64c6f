"""Merkle manifest of a table, by time-forward processing over blocks of the trees.

Every row is a leaf; each group of rows has a tree of runs of three, and the roots of the groups, in order, have one more.
A node's label in a block is the last leaf below it and its level, so children come before their parent and a sweep in
label order needs only the messages that wait for parents still ahead. Spark's shuffle and sort are the external part of
the queue: they bring the digests of a block, in label order, to one task, and the task's heap holds what crosses no
block. A block is ``LEVELS`` levels high, so a round of shuffles climbs that many levels, and no task gets more of a group
than a block at a time however large the group is. The reversed sweep sends each block the part of the proofs above it,
and within the block every parent sends its children theirs in descending label order.

Digests are raw bytes in tables and hex text inside hashes. A proof is a string of levels from the leaf up: one byte
``4 * place + siblings``, then the siblings from left to right.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.corpus import BATCH_ROWS, small_batches, stored

RUN = 3
# Levels of a block: 2187 leaves at most.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIZE = 32


def row_digest(values: Sequence[Column]) -> Column:
    """SHA-256, as bytes, of the values: ``-`` for null, else the bytes of the value as text, ``:``, and the text."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def joined(digests: Sequence[bytes]) -> bytes:
    """The node above the digests."""
    return sha256(b"".join(digests).hex().encode()).digest()


def height(total: int) -> int:
    """Levels above that many leaves."""
    levels = 0
    while total > 1:
        total, levels = -(-total // RUN), levels + 1
    return levels


def siblings(proof: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Place within its run, and the other nodes of the run, of each level of a proof."""
    at = 0
    while at < len(proof):
        place, count = divmod(proof[at], 4)
        yield place, [proof[at + 1 + SIZE * k : at + 1 + SIZE * (k + 1)] for k in range(count)]
        at += 1 + SIZE * count


def proof_digest(proof: bytes) -> bytes:
    """The hash of all siblings of a proof, level by level and left to right."""
    return joined([digest for _, level in siblings(proof) for digest in level])


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf has with the siblings of a proof."""
    for place, level in siblings(proof):
        leaf = joined([*level[:place], leaf, *level[place:]])
    return leaf


class Sweep:
    """Nodes of one block of a tree of ``total`` leaves, in label order.

    Leaves are given one by one; ``above`` yields every inner node that is complete, with its level, place in the level
    and children. Only messages for parents still ahead are held.
    """

    def __init__(self, block: int, total: int, levels: int) -> None:
        self.first = block * RUN**levels
        self.last = min(self.first + RUN**levels, total) - 1
        self.top = min(levels, height(total))
        self.queue: list[tuple[int, int, int, bytes]] = []

    def _send(self, level: int, place: int, digest: bytes) -> None:
        """A message to the parent of a node, under the parent's label."""
        end = min((place // RUN + 1) * RUN ** (level + 1) - 1, self.last)
        heapq.heappush(self.queue, (end, level + 1, place, digest))

    def above(self, leaf: int, digest: bytes) -> Iterator[tuple[int, int, list[bytes], bytes]]:
        self._send(0, leaf, digest)
        while self.queue and self.queue[0][0] <= leaf:
            end, level, place, first = heapq.heappop(self.queue)
            children = [first]
            while self.queue and self.queue[0][:2] == (end, level):
                children.append(heapq.heappop(self.queue)[3])
            node = joined(children)
            yield level, place // RUN, children, node
            if level < self.top:
                self._send(level, place // RUN, node)


def _climbed(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """The top node of every block; rows come by group and index."""
    names, key, sweep, out = ["g", "index", "total", "digest"], None, None, []
    for batch in batches:
        for g, index, total, digest in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            block = index // RUN**levels
            if (g, block) != key:
                key, sweep = (g, block), Sweep(block, total, levels)
            for level, _, _, node in sweep.above(index, digest):
                if level == sweep.top:
                    out.append((g, block, -(-total // RUN**levels), node))
        if len(out) >= BATCH_ROWS:
            yield _batch(out, names, _NODE)
            out = []
    yield _batch(out, names, _NODE)


_NODE = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
_MESSAGE = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
_PROOF = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _ranked(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with the place of each within its group ``g`` in ascending order, and the rows of the group.

    Ranges of group and order are dealt to tasks and sorted there; the rows before a task's part of a group are summed
    from one count for each task and group.
    """
    keys = ["g", *order]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    sorted_rows = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), f"{purpose}-sorted")
    sorted_rows = sorted_rows.withColumn("task", F.shiftright("at", 33))
    parts = sorted_rows.groupBy("g", "task").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    group = Window.partitionBy("g")
    before = F.sum("held").over(group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "g", "task", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(group).alias("total")
    )
    out = sorted_rows.join(parts, ["g", "task"]).withColumn("index", F.col("at") + F.col("shift"))
    return stored(out.drop("at", "task", "shift"), f"{purpose}-ranked")


def _climb(leaves: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes at the foot of each round of blocks, from the leaves up, and the root of each group."""
    nodes = leaves.select("g", "index", "total", "digest")
    most = nodes.agg(F.max("total")).first()[0] or 0
    feet, roots = [leaves], nodes.where("total = 1")
    while most > 1:
        block = F.floor(F.col("index") / RUN**levels)
        dealt = nodes.where("total > 1").repartition("g", block).sortWithinPartitions("g", "index")
        above = dealt.mapInArrow(
            lambda batches: _climbed(batches, levels), "g string, index long, total long, digest binary"
        )
        nodes = stored(above, "merkle-nodes")
        roots = roots.union(nodes.where("total = 1"))
        most = -(-most // RUN**levels)
        feet.append(nodes)
    return feet[:-1] or feet, roots.select("g", "digest")


def _proofs(batches: Iterator[pa.RecordBatch], leaves: bool, levels: int) -> Iterator[pa.RecordBatch]:
    """Proofs of the rows of each block, of which the message from above comes first, then the nodes by index."""
    names = ["g", "block", "index", "total", "digest", "doc_id", "other", "proof", "mark"]
    out_names = ["doc_id", "digest", "other", "proof", "mark"] if leaves else ["g", "index", "proof", "mark"]
    kinds = _PROOF if leaves else _MESSAGE
    out: list[tuple] = []

    def finish() -> None:
        """The reversed sweep over the nodes of the block: parents send proofs to their children."""
        queue = [(-sweep.last, -sweep.top, block, message)]
        while queue:
            _, level, place, proof = heapq.heappop(queue)
            level = -level
            run = children[level, place]
            for k in range(len(run)):
                own = bytes([4 * k + len(run) - 1]) + b"".join(run[:k] + run[k + 1 :]) + proof
                child = place * RUN + k
                if level > 1:
                    end = min((child + 1) * RUN ** (level - 1) - 1, sweep.last)
                    heapq.heappush(queue, (-end, 1 - level, child, own))
                elif leaves:
                    doc_id, digest, other = rows[child - sweep.first]
                    out.append((doc_id, digest, other, own, mark))
                else:
                    out.append((key[0], child, own, mark))

    key = message = mark = sweep = None
    block, rows, children = 0, [], {}
    for batch in batches:
        for g, number, index, total, digest, doc_id, other, proof, marked in zip(
            *(batch.column(n).to_pylist() for n in names), strict=True
        ):
            if digest is None:
                if sweep:
                    finish()
                key, block, message, mark = (g, number), number, proof, marked
                sweep, rows, children = Sweep(number, total, levels), [], {}
                # A lone node has no run: what stands above it is its proof.
                lone = total == 1
                continue
            if lone:
                out.append((doc_id, digest, other, message, mark) if leaves else (g, index, message, mark))
                sweep = None
                continue
            rows.append((doc_id, digest, other))
            for level, place, run, _ in sweep.above(index, digest):
                children[level, place] = run
        while len(out) >= BATCH_ROWS:
            yield _batch(out[:BATCH_ROWS], out_names, kinds)
            out = out[BATCH_ROWS:]
    if sweep:
        finish()
    while out:
        yield _batch(out[:BATCH_ROWS], out_names, kinds)
        out = out[BATCH_ROWS:]


def _descend(feet: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Proofs of the leaves, from ``tops``: group, the proof above its root, and a mark that goes to all its leaves.

    A group's message enters at the round in which its nodes become one.
    """
    sizes = [foot.select("g", "total").distinct() for foot in feet]
    messages = None
    for k in reversed(range(len(feet))):
        foot = feet[k] if k == 0 else feet[k].where("total > 1")
        low = F.col("total") <= RUN**levels
        first = sizes[k].where(low if k == 0 else low & (F.col("total") > 1)).join(tops, "g")
        entering = first.select("g", F.lit(0).cast("long").alias("block"), "total", "proof", "mark")
        if messages is not None:
            passing = messages.join(sizes[k], "g").where("total > 1")
            entering = entering.union(passing.select("g", F.col("index").alias("block"), "total", "proof", "mark"))
        empty = {n: F.lit(None).cast(t) for n, t in (("digest", "binary"), ("doc_id", "long"), ("other", "binary"))}
        down = entering.select("g", "block", F.lit(-1).cast("long").alias("index"), "total", *[v.alias(n) for n, v in empty.items()], "proof", "mark")
        nothing = F.lit(None).cast("binary")
        nodes = foot.select(
            "g", F.floor(F.col("index") / RUN**levels).alias("block"), "index", "total", "digest",
            *[F.col(n) if k == 0 and n in foot.columns else empty[n].alias(n) for n in ("doc_id", "other")],
            nothing.alias("proof"), nothing.alias("mark"),
        )
        dealt = down.union(nodes).repartition("g", "block").sortWithinPartitions("g", "block", "index")
        at_leaves = k == 0 and "doc_id" in foot.columns
        schema = (
            "doc_id long, digest binary, other binary, proof binary, mark binary"
            if at_leaves
            else "g string, index long, proof binary, mark binary"
        )
        out = dealt.mapInArrow(lambda batches, leaves=at_leaves: _proofs(batches, leaves, levels), schema)
        messages = out if k == 0 else stored(out, "merkle-proofs")
    return messages


def manifest(
    docs: DataFrame,
    id_column: str = "doc_id",
    group_column: str = "source",
    fields: Sequence[str] = FIELDS,
    changed: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, leaf, subroot, root, proof (all bytes), and ``other``.

    ``other`` is the leaf that the row has with the columns of ``changed`` in place of its own. Rows of a group ascend by
    id (null first), rows of one id by leaf; groups ascend bytewise, null first. Values are taken as text, null and the
    empty text differ. Repeated rows are leaves of their own, other columns are not read, and an empty table has no rows
    and no root. ``levels`` is the height of a block.
    """
    small_batches(docs.sparkSession)
    own = {f: F.col(f"`{f}`") for f in fields}
    group = F.col(f"`{group_column}`").cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("g"),
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        row_digest(list(own.values())).alias("digest"),
        row_digest(list((own | (changed or {})).values())).alias("other"),
    )
    rows = stored(rows, "merkle-rows")
    leaves = _ranked(rows, ["doc_id", "digest"], "merkle-leaves")
    feet, subroots = _climb(leaves, levels)
    groups = _ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), ["name"], "merkle-groups")
    group_feet, top = _climb(groups, levels)
    found = top.first()
    root = found["digest"] if found else b""
    above = _descend(group_feet, _constant(groups.sparkSession, root), levels)
    # Messages to the groups carry the subroot to every leaf.
    named = above.join(groups.select(F.col("index"), F.col("name"), F.col("digest").alias("subroot")), "index")
    tops = stored(named.select(F.col("name").alias("g"), "proof", F.col("subroot").alias("mark")), "merkle-tops")
    proofs = _descend(feet, tops, levels)
    return proofs.select(
        "doc_id", F.col("digest").alias("leaf"), F.col("mark").alias("subroot"), F.lit(root).alias("root"), "proof", "other"
    )


def _constant(spark, root: bytes) -> DataFrame:
    """The message to the tree of the groups: nothing stands above its root."""
    return spark.createDataFrame([("", b"", root)], "g string, proof binary, mark binary")


def verified(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, of which every row with an even crc32 of its id is then read without line breaks."""
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1, F.lit(True))
    broken = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    rows = manifest(docs, changed={"text": F.when(odd, F.col("text")).otherwise(broken)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed, folded = [], []
            for proof, other in zip(batch.column("proof").to_pylist(), batch.column("other").to_pylist(), strict=True):
                hashed.append(proof_digest(proof).hex())
                folded.append(fold(other, proof).hex())
            texts = [pa.array([d.hex() for d in batch.column(n).to_pylist()], pa.string()) for n in names[1:4]]
            columns = [batch.column("doc_id"), *texts, pa.array(hashed, pa.string()), pa.array(folded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return rows.mapInArrow(run, schema).withColumn("verified", F.col("folded_root") == F.col("root"))
