"""Ingest by a ledger of deliveries: files may gain, lose and reorder columns, and come again under an old name.

A delivery is a file's path, size and modification time. What the ledger doesn't hold is new: a file never seen, or new
content under an old name. Deliveries are taken in batches of bounded size, oldest first. A batch's rows are written to
a folder of its own, and then its ledger lines, which make the rows visible. A crash between the two leaves a folder that
the next run overwrites, so no row is lost or repeated.

The header of each file is read, and its columns are mapped by name: declared columns that a file lacks are NULL, and
columns that the feed doesn't declare go to a map column and to the ledger.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyforge.sources.feeds import EXTRA, INGESTED_AT, RESCUED, SOURCE_FILE
from tallyforge.sources.files import CSV_OPTIONS

BATCH = "_batch"
# Files of a batch; their paths and headers pass through the driver.
MAX_FILES = 10_000
LEDGER_SCHEMA = (
    "path string, length long, modified timestamp, batch long, header array<string>, unknown array<string>, "
    "missing array<string>, rows long, landed_at timestamp"
)
_DELIVERY = ["path", "length", "modified"]
# The path as it is, and as Spark names it in the rows of a file, with blanks and signs encoded.
_FILES = "path string, modificationTime timestamp, length long, content binary"
_LISTED = ["path", "_metadata.file_path AS name", "length", "modificationTime AS modified"]


class Deliveries:
    """Bronze rows of one feed below ``out``, and the ledger beside them."""

    def __init__(self, spark: SparkSession, schema: T.StructType, out: str) -> None:
        self.spark, self.schema, self.out = spark, schema, out.rstrip("/")

    @property
    def ledger_path(self) -> str:
        return f"{self.out}__ledger"

    def ledger(self) -> DataFrame:
        """One line for each delivery that has landed."""
        if not _exists(self.spark, self.ledger_path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger_path)

    def rows(self, after: int = 0) -> DataFrame:
        """Rows of all batches in the ledger that came after the given one."""
        full = T.StructType(
            [
                *self.schema.fields,
                T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType())),
                T.StructField(RESCUED, T.StringType()),
                T.StructField(INGESTED_AT, T.TimestampType()),
                T.StructField(SOURCE_FILE, T.StringType()),
            ]
        )
        last = self.last_batch()
        if not last:
            return self.spark.createDataFrame([], full.add(BATCH, T.LongType()))
        read = self.spark.read.schema(full.add(BATCH, T.LongType()))
        if not after:
            return read.parquet(self.out).where(F.col(BATCH) <= last)
        # A folder for each batch: only those asked for are listed and read.
        folders = self.folders(after)
        if not folders:
            return self.spark.createDataFrame([], full)
        return read.option("basePath", self.out).parquet(*folders)

    def folders(self, after: int = 0) -> list[str]:
        """Folders of the batches with rows that came after the given one."""
        filled = self.ledger().where((F.col("batch") > after) & (F.col("rows") > 0)).select("batch").distinct()
        return [f"{self.out}/{BATCH}={r.batch}" for r in filled.collect()]

    def last_batch(self) -> int:
        return self.ledger().agg(F.max("batch")).first()[0] or 0

    def waiting(self, folder: str, pattern: str) -> DataFrame:
        """Deliveries in ``folder`` that the ledger doesn't hold."""
        return self._new(self._listed(folder, pattern))

    def _listed(self, folder: str, pattern: str) -> DataFrame:
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        return listed.selectExpr(*_LISTED)

    def _new(self, listed: DataFrame) -> DataFrame:
        known = self.ledger().select(*_DELIVERY)
        return listed.join(known, _DELIVERY, "left_anti").select("path", "name", "length", "modified")

    def land_waiting(self, folder: str, pattern: str, max_files: int = MAX_FILES, clean: bool = False) -> int:
        """Land all that waits; returns the number of files.

        With ``clean`` the files of a batch are deleted once the ledger holds them, as are those that a run which died
        had landed.
        """
        landed = 0
        while True:
            if clean:
                self._clean(folder, pattern)
            step = self.waiting(folder, pattern).orderBy("modified", "path").limit(max_files).collect()
            if not step:
                return landed
            self._land([tuple(r) for r in step])
            landed += len(step)

    def _clean(self, folder: str, pattern: str) -> None:
        """Delete files that have landed; one that has changed since is another delivery and stays."""
        known = self._listed(folder, pattern).join(self.ledger().select(*_DELIVERY), _DELIVERY, "left_semi")
        for file, length, modified in known.selectExpr("path", "length", "unix_millis(modified)").collect():
            path = self.spark._jvm.org.apache.hadoop.fs.Path(file)
            files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            found = files.getFileStatus(path)
            if (found.getLen(), found.getModificationTime()) == (length, modified):
                files.delete(path, False)

    def watch(self, folder: str, pattern: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        """Land new files as a stream, until stopped or, without an interval, until none waits.

        The stream names each path once; the ledger decides whether it is landed, so a replayed batch repeats nothing.
        Files that changed are found by ``land_waiting``.
        """
        source = self.spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern)
        source = source.option("maxFilesPerTrigger", MAX_FILES).option("maxFileAge", "36500d").load(folder)
        files = source.selectExpr(*_LISTED)

        def take(batch: DataFrame, _: int) -> None:
            found = [tuple(r) for r in self._new(batch).orderBy("modified", "path").collect()]
            if found:
                self._land(found)

        writer = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

    def headers(self, paths: Sequence[str]) -> dict[str, str]:
        """First line of each file that has one, by its name in rows."""
        lines = self.spark.read.text(list(paths)).select(
            F.col("_metadata.file_path").alias("name"),
            F.col("_metadata.file_block_start").alias("start"),
            "value",
            F.monotonically_increasing_id().alias("at"),
        )
        # Only a file's first split holds its header; rows of a split keep their order.
        first = lines.where("start = 0").groupBy("name").agg(F.min_by("value", "at").alias("line"))
        return {r.name: r.line for r in first.collect()}

    def _land(self, found: Sequence[tuple]) -> None:
        batch = self.last_batch() + 1
        lines = self.headers([path for path, *_ in found])
        groups: dict[str, list[str]] = {}
        for path, name, *_ in found:
            if name in lines:
                groups.setdefault(lines[name], []).append(path)
        parts = [self._read(header_names(line), paths) for line, paths in groups.items()]
        target = f"{self.out}/{BATCH}={batch}"
        if parts:
            rows = reduce(DataFrame.unionByName, parts).withColumn(INGESTED_AT, F.current_timestamp())
            rows.write.mode("overwrite").option("compression", "zstd").parquet(target)
            counted = self.spark.read.parquet(target).groupBy(SOURCE_FILE).count().collect()
        else:
            counted = []
        self._commit(found, batch, lines, {r[SOURCE_FILE]: r["count"] for r in counted})

    def _commit(self, found: Sequence[tuple], batch: int, lines: dict[str, str], counts: dict[str, int]) -> None:
        """Ledger lines of a batch, as one file."""
        declared = self.schema.fieldNames()
        entries = []
        for path, file, length, modified in found:
            names = header_names(lines[file]) if file in lines else []
            unknown = [n for n in names if n not in declared]
            missing = [n for n in declared if n not in names]
            entries.append((path, length, modified, batch, names, unknown, missing, counts.get(file, 0)))
        kept = LEDGER_SCHEMA.rsplit(", ", 1)[0]
        frame = self.spark.createDataFrame(entries, kept).withColumn("landed_at", F.current_timestamp())
        frame.coalesce(1).write.mode("append").parquet(self.ledger_path)

    def _read(self, names: Sequence[str], paths: Sequence[str]) -> DataFrame:
        """Rows of files with one header: declared columns by name, the others as a map.

        A line with the wrong number of cells is kept, with its full text in the rescue column.
        """
        cells = [f"c{k}" for k in range(len(names))]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, RESCUED]])
        options = CSV_OPTIONS | {"enforceSchema": "true", "columnNameOfCorruptRecord": RESCUED}
        read = self.spark.read.schema(schema).options(**options).csv(list(paths))
        place = {name: cell for name, cell in zip(names, cells, strict=True)}
        declared = self.schema.fieldNames()
        extra = [item for name, cell in place.items() if name not in declared for item in (F.lit(name), F.col(cell))]
        nothing = F.lit(None).cast("map<string,string>")
        return read.select(
            *[(F.col(place[n]) if n in place else F.lit(None).cast("string")).alias(n) for n in declared],
            (F.create_map(*extra) if extra else nothing).alias(EXTRA),
            F.col(RESCUED),
            F.col("_metadata.file_path").alias(SOURCE_FILE),
        )


def header_names(line: str) -> list[str]:
    """Column names of a header line; a repeated name gets its number."""
    names: list[str] = []
    for cell in next(csv.reader(io.StringIO(line.removeprefix("﻿"))), []):
        name, number = cell.strip(), 2
        while name in names:
            name, number = f"{cell.strip()}#{number}", number + 1
        names.append(name)
    return names


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
