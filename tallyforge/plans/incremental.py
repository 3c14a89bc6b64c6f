"""Cleaned tables kept up to date from new deliveries alone.

A table's rows lie in buckets by hash of the key. A refresh reads the batches that landed since the last one, takes the
newest row of each key they touch, and rewrites only the buckets of these keys, into a folder of the new version. Much
data is taken in rounds of some buckets each, whose intermediate rows and shuffle files go before the next. Then a
manifest line names the version of each bucket, and last the table's view moves to these folders in one catalog call. So
readers see the old rows or the new ones, and a refresh that dies is repeated or completed by the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.quality import Expectation, keep_valid, observe_expectations
from tallyforge.operators.silver import RESCUED_LINES, cast_rules, latest_deliveries, typed_columns
from tallyforge.session import brief_shuffles, stored, stored_bytes
from tallyforge.sources.feeds import RESCUED, Feed
from tallyforge.sources.warehouse import Warehouse
from tallyforge.streaming.deliveries import Deliveries

BUCKETS = 32
# Stored bytes of a round, of landed and old rows together; a round takes one bucket at least.
ROUND_BYTES = 2**29
BUCKET = "_bucket"
MANIFEST_SCHEMA = "version int, batch long, buckets int, places map<int,int>"


@dataclass(frozen=True)
class Version:
    """A state of a table: the last batch it holds, and the version whose folder holds each bucket."""

    version: int
    batch: int
    buckets: int
    places: dict[int, int]


class SilverVersions:
    """The cleaned table of one feed as a view over versioned buckets; one writer at a time."""

    def __init__(
        self, warehouse: Warehouse, feed: Feed, buckets: int = BUCKETS, round_bytes: int = ROUND_BYTES
    ) -> None:
        self.warehouse, self.spark, self.feed, self.buckets = warehouse, warehouse.spark, feed, buckets
        self.round_bytes = round_bytes
        place = self.spark.catalog.getDatabase(warehouse.database).locationUri.rstrip("/")
        self.base = f"{place}/{feed.silver_table}__versions"

    def current(self) -> Version:
        """The last version that the manifest names; the number of buckets is that of the first one."""
        try:
            lines = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.base}/manifest")
            last = lines.orderBy(F.desc("version")).first()
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            last = None
        if last is None:
            return Version(0, 0, self.buckets, {})
        return Version(last.version, last.batch, last.buckets, dict(last.places))

    def _folder(self, version: int) -> str:
        return f"{self.base}/v={version}"

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.hash(self.feed.key), F.lit(buckets))

    def _landed_bucket(self, buckets: int) -> Column:
        """Bucket of a row that is still text: the typed key decides."""
        kind = dict(self.feed.columns)[self.feed.key]
        key = F.col(self.feed.key) if kind == "string" else F.col(self.feed.key).try_cast(kind)
        return F.pmod(F.hash(key), F.lit(buckets))

    def _paths(self, places: dict[int, int], wanted: list[int]) -> list[str]:
        return [f"{self._folder(places[b])}/{BUCKET}={b}" for b in wanted if b in places]

    def _rows(self, places: dict[int, int], wanted: list[int]) -> DataFrame | None:
        """Rows of the wanted buckets; folders of other buckets are not read."""
        paths = self._paths(places, wanted)
        return self.spark.read.parquet(*paths) if paths else None

    def _rounds(self, touched: list[int], old: Version, deliveries: Deliveries) -> list[list[int]]:
        """The touched buckets by round; one round also where there is none."""
        size = stored_bytes(self.spark, deliveries.folders(old.batch) + self._paths(old.places, touched))
        number = max(1, min(len(touched), ceil(size / self.round_bytes)))
        # Neighbours together: every n-th bucket would meet few of the shuffle partitions, which go by the same hash.
        return [touched[k * len(touched) // number : (k + 1) * len(touched) // number] for k in range(number)]

    def refresh(self, deliveries: Deliveries) -> dict[str, int]:
        """Take in what has landed since the last refresh; returns the violation counts of the rows taken in.

        Gives the rows that a rebuild from all of bronze gives: a later batch has later rows, a line with the wrong number
        of cells replaces nothing, and a key whose newest row fails a dropping rule has none.
        """
        old, last = self.current(), deliveries.last_batch()
        if last == old.batch and old.version:
            self._show(old)
            return {"rows": 0}
        landed = deliveries.rows(after=old.batch)
        bucket = self._landed_bucket(old.buckets)
        whole = landed.where(F.col(RESCUED).isNull())
        touched = sorted(r[BUCKET] for r in whole.select(bucket.alias(BUCKET)).distinct().collect())
        rounds = self._rounds(touched, old, deliveries)
        version, counts = old.version + 1, {}
        for number, wanted in enumerate(rounds):
            part = landed if len(rounds) == 1 else landed.where(bucket.isin(wanted))
            found = self._merge(part, old, wanted, version, "append" if number else "overwrite")
            counts = {name: counts.get(name, 0) + count for name, count in found.items()}
        counts[RESCUED_LINES] = landed.where(F.col(RESCUED).isNotNull()).count()
        filled = self._filled(version) if touched else set()
        places = {b: v for b, v in old.places.items() if b not in touched} | {b: version for b in filled}
        new = Version(version, last, old.buckets, places)
        self._commit(new)
        self._show(new)
        self._clean(old, new)
        return counts

    def _merge(self, landed: DataFrame, old: Version, wanted: list[int], version: int, mode: str) -> dict[str, int]:
        """Write the buckets of a round into the version's folder; returns the counts of its newest rows."""
        raw, casts = observe_expectations(
            latest_deliveries(landed, self.feed), cast_rules(self.feed), f"{self.feed.silver_table}_casts"
        )
        # Counted, not yet dropped: also a row that fails takes the place of its key's old row.
        soft = [Expectation(rule.name, rule.predicate) for rule in self.feed.rules]
        typed, rules = observe_expectations(raw.select(*typed_columns(self.feed)), soft, f"{self.feed.silver_table}_rules")
        with stored([typed], f"{self.feed.silver_table}-fresh") as fresh:
            merged = keep_valid(fresh, self.feed.rules)
            before = self._rows(old.places, wanted)
            if before is not None:
                kept = before.join(fresh.select(self.feed.key), self.feed.key, "left_anti")
                merged = kept.select(merged.columns).union(merged)
            # One shuffle: the join, like the folders, goes by the key's bucket or by the key.
            dealt = merged.withColumn(BUCKET, self._bucket(old.buckets)).hint("rebalance", BUCKET)
            writer = dealt.write.mode(mode).option("compression", "zstd").partitionBy(BUCKET)
            with brief_shuffles(self.spark):
                writer.parquet(self._folder(version))
        return {**casts.get, **rules.get}

    def _filled(self, version: int) -> set[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(version))
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        names = [str(entry.getPath().getName()) for entry in found]
        return {int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET}=")}

    def _commit(self, new: Version) -> None:
        row = (new.version, new.batch, new.buckets, new.places)
        self.spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/manifest")

    def _show(self, version: Version) -> None:
        """Point the table's view to a version, with its tier as a property."""
        columns = ", ".join(f"`{c}`" for c, _ in self.feed.columns)
        by_version: dict[int, list[int]] = {}
        for bucket, place in sorted(version.places.items()):
            by_version.setdefault(place, []).append(bucket)
        parts = [
            f"SELECT {columns} FROM parquet.`{self._folder(v)}` WHERE {BUCKET} IN ({', '.join(map(str, numbers))})"
            for v, numbers in by_version.items()
        ]
        if not parts:
            nothing = ", ".join(f"CAST(NULL AS {kind}) AS `{c}`" for c, kind in self.feed.columns)
            parts = [f"SELECT {nothing} WHERE false"]
        name = self.warehouse.qualified(self.feed.silver_table)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('quality' = 'silver') AS {' UNION ALL '.join(parts)}")

    def _clean(self, old: Version, new: Version) -> None:
        """Remove folders that neither this version nor the one before it, which may still be read, needs."""
        needed = set(old.places.values()) | set(new.places.values())
        for version in range(max(1, new.version - 2 * new.buckets), new.version):
            if version not in needed:
                self.warehouse._delete(self._folder(version))
