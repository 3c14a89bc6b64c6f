"""Size-aware Jaccard join of word-shingle sets and the components of its links.

Two sets link when ``100 * |A and B| >= percent * |A or B|``. Equal sets form one class (node) first. Small and large
classes take different ways, both exact:

* **light** (up to ``boundary`` shingles): for every partner size up to the boundary, every subset of the overlap that
  such a pair needs is a key, so that linked sets share a key;
* **heavy**: shingles are ordered once for all sets, those met often in the corpus last; a set enters the inverted lists
  of its first ``n - ceil(percent * n) + 1`` shingles, and linked sets share one of these. Light sets that may link to a
  heavy one enter the lists too.

The boundary is the one with the least estimated cost, from the sizes of the small classes and the mean list length.

Lists are scanned in two rounds, so that a group of near copies costs its size and not its square: each member is first
compared with the pivot of its list (the member that shares most of its listed shingles), then only members that are in
different components yet, and only in lists that stand early enough in both sets for the overlap that they need. Before two sets are compared, sketches (how many shingles fall into each range of codes, a
range for every few shingles) bound their overlap from above; whole sets are sent only for pairs within the bound. Long lists are salted.

Shingles and sets are compared by 64-bit codes. Links, classes and components stay in tables; the driver gets the
frequent shingles (at most ``FREQUENT``; they only set the order) and the counts of sizes up to ``LIGHT_MOST``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.components import connected_components
from tallyforge.llm.corpus import mix, shingle_sets, stored, text_pieces, window_codes

WIDTH = 5
PERCENT = 75
# Most shingles that are known as frequent, and in how many different sets among CHUNK shingles a task must meet one to
# report it: a shingle of few sets then stands first in a set's order also where each task meets it seldom.
FREQUENT = 1 << 17
REPORTED, CHUNK = 2, 1 << 21
# Sets above this size are never light.
LIGHT_MOST = 12
# Posting rows for each bucket; salts of a frequent shingle's list; posting rows that a task gathers before it sends.
BUCKET_ROWS, SALTS, SENT_ROWS = 1 << 17, 32, 1 << 19

# List, class, its size, and the place of the shingle in the class's order (0 for subset keys).
POSTING = np.dtype([("h", "<u8"), ("node", "<u8"), ("n", "<i4"), ("at", "<i4")])


def needed(a: int, b: int, percent: int) -> int:
    """Least overlap of linked sets with ``a`` and ``b`` shingles."""
    return -(-percent * (a + b) // (100 + percent))


def partners(n: int, most: int, percent: int) -> range:
    """Sizes up to ``most`` that a set of ``n`` can link to."""
    return range(-(-percent * n // 100), min(most, 100 * n // percent) + 1)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def light_keys(n: int, boundary: int, percent: int) -> int:
    return sum(comb(n, needed(n, m, percent)) for m in partners(n, boundary, percent) if needed(n, m, percent) <= n)


def choose_boundary(sizes: dict[int, int], list_length: float, percent: int) -> int:
    """Largest light size with the least cost: subset keys of light sets plus scanned postings of all others."""

    def cost(boundary: int) -> float:
        keys = sum(c * light_keys(n, boundary, percent) for n, c in sizes.items() if n <= boundary)
        listed = [n for n in sizes if n > boundary or 100 * n >= percent * (boundary + 1)]
        return keys + sum(sizes[n] * prefix_length(n, percent) * (1 + list_length) for n in listed)

    return min(range(LIGHT_MOST + 1), key=cost)


def set_code(shingles: np.ndarray) -> int:
    return int(mix(np.add.reduce(mix(shingles)) + np.array([len(shingles)], dtype=np.uint64))[0])


def sketch(shingles: np.ndarray) -> bytes:
    """Number of shingles in each of 2 ** k equal ranges, cut at 255; at least 256, and more than n / 8 ranges."""
    bits = max(8, len(shingles).bit_length() - 3)
    counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def most_overlap(left: bytes, right: bytes) -> int | None:
    """Upper bound of the overlap of two sets from their sketches; None where counts were cut."""
    a, b = (np.frombuffer(x, dtype=np.uint8).astype(np.int64) for x in (left, right))
    if a.max() == 255 or b.max() == 255:
        return None
    ranges = min(len(a), len(b))
    return int(np.minimum(a.reshape(ranges, -1).sum(1), b.reshape(ranges, -1).sum(1)).sum())


def _signed(values: Iterable[int] | np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def _describe(width: int):
    """Rows of every document (kind 0: id, set code, size) and of shingles met often (kind 1: shingle, count of sets).

    Rows of kind 2 hold the shingles and distinct shingles of a chunk, for the mean list length. Equal sets of a chunk
    count once, since they are one class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        count = 0

        def report() -> Iterator[pa.RecordBatch]:
            nonlocal count
            if held:
                found, times = np.unique(np.concatenate(held), return_counts=True)
                often = times >= REPORTED
                keys, ns = [*found[often], len(found)], [*times[often], count]
                kinds = [*[1] * int(often.sum()), 2]
                yield _table(kinds, [None] * len(kinds), np.array(keys, dtype=np.uint64), ns)
            held.clear()
            seen.clear()
            count = 0

        for batch in batches:
            for piece in text_pieces(batch.column(1)):
                sets = shingle_sets(piece, width)
                ids = batch.column(0).slice(piece.first, piece.last - piece.first)
                codes = np.array([set_code(s) if len(s) else 0 for s in sets], dtype=np.uint64)
                yield _table([0] * len(sets), ids, codes, [len(s) for s in sets], list(map(sketch, sets)))
                for code, s in zip(codes.tolist(), sets, strict=True):
                    if code not in seen:
                        seen.add(code)
                        held.append(s)
                        count += len(s)
                if count >= CHUNK:
                    yield from report()
        yield from report()

    def _table(kinds, ids, keys, ns, sketches=None) -> pa.RecordBatch:
        ids = ids if isinstance(ids, pa.Array) else pa.array(ids, pa.int64())
        sketches = pa.array(sketches or [None] * len(kinds), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), ids, _signed(keys), pa.array(ns, pa.int64()), sketches],
            ["kind", "doc_id", "key", "n", "sketch"],
        )

    return run


def _light_postings(by_size: dict[int, list[tuple[int, np.ndarray]]], boundary: int, percent: int):
    for n, members in by_size.items():
        nodes = np.array([node for node, _ in members], dtype=np.uint64)
        table = np.stack([s for _, s in members])
        for m in partners(n, boundary, percent):
            k = needed(n, m, percent)
            tag = np.uint64(min(n, m) * 1009 + max(n, m))
            for chosen in combinations(range(n), k) if k <= n else ():
                key = np.full(len(nodes), tag)
                for column in chosen:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, column])
                yield key, nodes, n


def _post(width: int, percent: int, boundary: int, buckets: int, frequent: np.ndarray, rank: np.ndarray):
    """Posting rows of each class, once for each task, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        count = 0

        def rows(h: np.ndarray, node, n: int, at) -> np.ndarray:
            out = np.empty(len(h), dtype=POSTING)
            out["h"], out["node"], out["n"], out["at"] = h, node, n, at
            return out

        def send() -> Iterator[pa.RecordBatch]:
            nonlocal count
            if not held:
                return
            block = np.concatenate(held)
            held.clear()
            count = 0
            bucket = (block["h"] % np.uint64(buckets)).astype(np.int64)
            salted = np.isin(block["h"], frequent)
            bucket[salted] += buckets * (1 + (block["node"][salted] % np.uint64(SALTS)).astype(np.int64))
            order = np.argsort(bucket, kind="stable")
            block, bucket = block[order], bucket[order]
            found, first = np.unique(bucket, return_index=True)
            parts = [part.tobytes() for part in np.split(block, first[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(parts, pa.binary())], ["bucket", "postings"]
            )

        for batch in batches:
            for piece in text_pieces(batch.column(0)):
                small: dict[int, list[tuple[int, np.ndarray]]] = {}
                for s in shingle_sets(piece, width):
                    n = len(s)
                    if n < 2 or (code := set_code(s)) in seen:
                        continue
                    if len(seen) >= 1 << 20:
                        seen.clear()
                    seen.add(code)
                    if n <= boundary:
                        small.setdefault(n, []).append((code, s))
                        if 100 * n < percent * (boundary + 1):
                            continue
                    times = np.zeros(n, dtype=np.int64)
                    if len(frequent):
                        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                        times = np.where(frequent[at] == s, rank[at], 0)
                    first = np.argsort(times, kind="stable")[: prefix_length(n, percent)]
                    held.append(rows(s[first], code, n, np.arange(len(first))))
                    count += len(first)
                for keys, nodes, n in _light_postings(small, boundary, percent):
                    held.append(rows(keys, nodes, n, 0))
                    count += len(keys)
                if count >= SENT_ROWS:
                    yield from send()
        yield from send()

    return run


def _lists(buckets: int):
    """Members of each inverted list of a bucket; a list of one is left out unless it is a salted part."""

    def run(group: pa.Table) -> pa.Table:
        parts = group.column("postings").to_pylist()
        block = np.unique(np.frombuffer(b"".join(parts), dtype=POSTING))
        if group.column("bucket")[0].as_py() < buckets:
            _, inverse, times = np.unique(block["h"], return_inverse=True, return_counts=True)
            block = block[times[inverse] > 1]
        plain = [pa.array(np.ascontiguousarray(block[c])) for c in ("n", "at")]
        return pa.table([_signed(block["h"]), _signed(block["node"]), *plain], names=["h", "node", "n", "at"])

    return run


def _packed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch.column(0)):
                sets = [s for s in shingle_sets(piece, width) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [_signed([set_code(s) for s in sets]), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "shingles"],
                )

    return run


def _may_link(percent: int):
    """Pairs whose sketches allow the overlap that a link needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right, n, m in zip(*(batch.column(c).to_pylist() for c in ("left", "right", "n", "m")), strict=True):
                most = most_overlap(left, right)
                keep.append(most is None or most >= needed(n, m, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (left, right))
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _compatible(a: str, b: str, percent: int):
    low, high = F.least(a, b), F.greatest(a, b)
    return F.lit(100) * low >= F.lit(percent) * high


def _prefix_column(n: str, percent: int) -> Column:
    return F.col(n) - F.ceil(F.lit(percent) * F.col(n) / 100) + 1


def _early_in_both(percent: int) -> Column:
    """Whether the list of a pair stands early enough in both sets for the overlap that a link needs.

    Behind the first common shingle at least ``needed - 1`` more follow in each set, so linked sets always have one
    list that passes. Subset keys stand at 0 and always pass.
    """
    least = F.ceil(F.lit(percent) * (F.col("n") + F.col("m")) / (100 + percent))
    return (F.col("at") <= F.col("n") - least) & (F.col("its_at") <= F.col("m") - least)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _verify(pairs: DataFrame, sketches: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that link. ``sketches``: node, smallest id, n, sketch of the classes; ``rows``: all documents."""
    left = sketches.select(F.col("node").alias("a"), "n", F.col("sketch").alias("left"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "left", "right")
    near = stored(joined.mapInArrow(_may_link(percent), "a long, b long"), "jaccard-near")
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    members = stored(nodes.join(sketches, "node").select(F.col("smallest").alias("doc_id")), "jaccard-members")
    texts = rows.join(members, "doc_id", "left_semi").select("text")
    sets = stored(texts.mapInArrow(_packed(width), "node long, shingles binary"), "jaccard-sets")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    joined = near.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return stored(joined.mapInArrow(_linked(percent), "a long, b long"), "jaccard-links")


def jaccard_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id.

    A text without words, or null, has no shingles and is alone. Rows with equal sets are in one component; its id is
    the smallest id of its rows. A row with a null id has a null component_id and joins no others. Repeated rows give
    repeated results; an empty table gives none; columns other than the two named ones are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    described = stored(
        rows.mapInArrow(_describe(width), "kind int, doc_id long, key long, n long, sketch binary"), "jaccard-described"
    )
    every = described.where("kind = 0").select("doc_id", F.col("key").alias("node"), "n")
    named = every.where("doc_id IS NOT NULL AND n > 0")
    classes = named.groupBy("node").agg(F.min("doc_id").alias("smallest"), F.min("n").alias("n"))

    often = described.where("kind = 1").groupBy("key").agg(F.sum("n").alias("times"))
    top = often.orderBy(F.desc("times"), "key").limit(FREQUENT).toArrow().to_pandas()
    keys = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    totals = described.agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("shingles"),
        F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("met"),
        F.sum(F.when(F.col("kind") == 2, F.col("key"))).alias("distinct"),
    ).first()
    sizes = {
        r["n"]: r["count"] for r in classes.where(F.col("n") <= LIGHT_MOST).groupBy("n").count().collect()
    }
    boundary = choose_boundary(sizes, (totals["met"] or 0) / max(1, totals["distinct"] or 0), percent)
    buckets = 1 + (totals["shingles"] or 0) * (100 - percent) // 100 // BUCKET_ROWS

    texts = rows.where("doc_id IS NOT NULL").select("text")
    post = _post(width, percent, boundary, buckets, keys[order], top["times"].to_numpy(np.int64)[order])
    posted = texts.mapInArrow(post, "bucket long, postings binary").groupBy("bucket")
    lists = stored(posted.applyInArrow(_lists(buckets), "h long, node long, n int, at int"), "jaccard-lists")

    listed = lists.select("node").distinct().join(classes, "node").drop("n")
    own = described.where("kind = 0").select(F.col("doc_id").alias("smallest"), F.col("key").alias("node"), "n", "sketch")
    sketches = stored(own.join(listed, ["smallest", "node"]), "jaccard-sketches")

    # Share of a class's listed shingles that others list too.
    shared = lists.groupBy("node").agg((F.count("*") / F.max(_prefix_column("n", percent))).alias("shared"))
    pivots = lists.join(shared, "node").groupBy("h").agg(F.max(F.struct("shared", "node", "n")).alias("p"))
    pivots = pivots.select("h", F.col("p.node").alias("other"), F.col("p.n").alias("m"))
    starred = lists.join(pivots, "h").where(F.col("node") != F.col("other")).where(_compatible("n", "m", percent))
    first = stored(_pairs(starred), "jaccard-pairs")
    links = _verify(first, sketches, rows, width, percent)
    joined = connected_components(links, "a", "b")

    # Members that are apart yet: those outside the largest component of their list, against all others of the list.
    rooted = lists.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stored(rooted.select("h", "node", "n", "at", "root"), "jaccard-rooted")
    parts = rooted.groupBy("h", "root").agg(F.count("*").alias("c"))
    main = parts.groupBy("h").agg(F.max(F.struct("c", "root")).alias("main"), F.count("*").alias("parts"))
    open_lists = main.where("parts > 1").select("h", F.col("main.root").alias("main"))
    minor = rooted.join(open_lists, "h").where(F.col("root") != F.col("main"))
    minor = minor.select("h", "node", "n", "at", "root", "main")
    others = rooted.select(
        "h", F.col("node").alias("other"), F.col("n").alias("m"), F.col("at").alias("its_at"), F.col("root").alias("its_root")
    )
    apart = minor.join(others, "h").where(F.col("root") != F.col("its_root")).where(_compatible("n", "m", percent))
    apart = apart.where(_early_in_both(percent))
    # Each pair once for each list: from the minor member, or from the smaller one of two minor members.
    apart = apart.where((F.col("its_root") == F.col("main")) | (F.col("node") < F.col("other")))
    second = stored(_pairs(apart).join(first, ["a", "b"], "left_anti"), "jaccard-pairs")
    more = _verify(second, sketches, rows, width, percent)
    ties = joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    final = connected_components(ties, "a", "b")

    # A component's least id reaches its members over salted keys, since one component may hold a third of all classes.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    members = stored(classes.join(final, "node").select("node", "smallest", "root"), "jaccard-labelled")
    least = members.groupBy("root").agg(F.min("smallest").alias("component_id")).select("root", "component_id", salts)
    members = members.withColumn("salt", F.pmod("node", F.lit(SALTS)).cast("int")).join(least, ["root", "salt"])
    labels = classes.join(members.select("node", "component_id"), "node", "left")
    labels = labels.select("node", F.coalesce("component_id", "smallest").alias("component_id"))
    known = named.join(labels, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = every.where("doc_id IS NULL OR n = 0")
    return known.unionByName(
        alone.select(
            "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).alias("component_id")
        )
    )


def keep_one_of_each_group(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows that link to a row of a smaller id, directly or over others.

    Of each component the row with the smallest id stays, of repeated rows one. Rows are told apart by a number and not
    by id, so another text of a repeated id is not touched. Rows without id or without words stay. An empty table gives
    an empty one; columns keep their order.
    """
    number = "row"
    while number in docs.columns:
        number += "_"
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "jaccard-numbered")
    ids = rows.where("doc_id IS NOT NULL")
    found = jaccard_components(ids, width, percent, id_column=number).where("n_shingles > 0")
    found = found.select(F.col("doc_id").alias("number"), "component_id")
    by_id = ids.select(F.col(number).alias("number"), F.col("doc_id").cast("long").alias("id"))
    found = stored(found.join(by_id, "number"), "jaccard-found")
    stay = found.groupBy("component_id").agg(F.min(F.struct("id", "number")).alias("least"))
    gone = found.join(stay.select(F.col("least.number").alias("number")), "number", "left_anti")
    return rows.join(gone.select(F.col("number").alias(number)), number, "left_anti").drop(number)
