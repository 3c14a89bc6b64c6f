"""Placement of rows on shards by a permutation-filled lookup table, with built-in functions only.

Every shard prefers the slots of a prime-sized table in an order of its own (offset and skip from its name). Shards take
turns, each claiming its next free slot, until the table is full: shares differ by one slot at most, and when a shard
joins or leaves few other slots change owner. A row's key is hashed to a slot; the table is broadcast, so a placement is
one look-up. The table has ``slots`` rows, a parameter, whatever the data.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 16381
SHARDS = [f"shard-{k:03d}" for k in range(64)]
# A key that has more than this share of the rows is spread by a second column.
HOT_SHARE = 0.01


def fill_table(shards: list[str], slots: int) -> list[int]:
    """Owner (place in ``shards``) of each slot; ``slots`` must be prime and not fewer than the shards."""
    if not 0 < len(shards) <= slots or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number and at least the number of shards")
    digests = [md5(name.encode()).hexdigest() for name in shards]
    offsets = [int(d[:15], 16) % slots for d in digests]
    skips = [int(d[15:30], 16) % (slots - 1) + 1 if slots > 1 else 0 for d in digests]
    owner, turn, free = [-1] * slots, offsets, slots
    while True:
        for shard in range(len(shards)):
            slot = turn[shard]
            while owner[slot] >= 0:
                slot = (slot + skips[shard]) % slots
            owner[slot] = shard
            turn[shard] = (slot + skips[shard]) % slots
            free -= 1
            if not free:
                return owner


def key_slot(key: Column, slots: int) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the slots; null counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(
    df: DataFrame, key: str = "doc_id", shards: list[str] = SHARDS, slots: int = SLOTS, spread_by: str | None = None
) -> DataFrame:
    """``df`` with columns slot and shard (name), in place of columns of those names.

    Equal keys share a shard, so repeated rows do. With ``spread_by``, a key with more than ``HOT_SHARE`` of all rows is
    hashed together with that column instead. All rows stay, an empty table stays empty.
    """
    plain = df.drop("slot", "shard")
    hashed = F.col(f"`{key}`").cast("string")
    if spread_by is not None:
        # At most 1 / HOT_SHARE keys.
        counts = plain.groupBy(F.col(f"`{key}`").alias("_hot")).agg(F.count("*").alias("n"))
        total = plain.count()
        hot = counts.where(F.col("n") > HOT_SHARE * total).select("_hot")
        plain = plain.join(F.broadcast(hot), plain[key].eqNullSafe(F.col("_hot")), "left")
        both = F.concat_ws("|", hashed, F.col(f"`{spread_by}`").cast("string"))
        hashed = F.when(F.col("_hot").isNotNull(), both).otherwise(hashed)
    owners = ",".join(shards[k] for k in fill_table(shards, slots))
    table = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard"))
    placed = plain.withColumn("slot", key_slot(hashed, slots)).join(F.broadcast(table), "slot")
    return placed.select(*[c for c in plain.columns if c != "_hot"], "slot", "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder for each shard; a shard's rows are written by as many tasks as their size needs."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
