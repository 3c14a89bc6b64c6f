"""Exact dedup against a persistent index of text digests.

The index is a table bucketed and sorted by digest: one row for each text ever seen, with the id that stays, the number
of its rows in the batch that brought it, and that batch. Rows are told apart by id; only rows of the kept id are
numbered, within a call, so a batch that is added again after a failure is decided as before whatever its layout. A batch is reduced to one row for each digest before any
shuffle (so a text that fills a third of the batch is one row for each task), anti-joined with the index by sort-merge
on equal buckets, and what is new is appended. Decisions join the batch's digests with the index; a hot digest there is
one side of a skewed join, which adaptive execution splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.corpus import stored
from tallyforge.session import scratch_path

INDEX_SCHEMA = "digest binary, keep_id long, group_size long, batch string"
# Digests for each bucket, and the least number of buckets of a new index.
BUCKET_DIGESTS, LEAST_BUCKETS = 1 << 20, 64


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, as bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


@dataclass(frozen=True)
class DigestIndex:
    """The table ``name`` below ``path``, made where it does not exist."""

    spark: SparkSession
    name: str
    path: str
    buckets: int = LEAST_BUCKETS

    def _append(self, rows: DataFrame) -> None:
        writer = rows.write.format("parquet").mode("append").option("path", self.path)
        writer.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)

    def table(self) -> DataFrame:
        if not self.spark.catalog.tableExists(self.name):
            self._append(self.spark.createDataFrame([], INDEX_SCHEMA))
        return self.spark.table(self.name)

    def add(
        self,
        docs: DataFrame,
        batch: str,
        id_column: str = "doc_id",
        text_column: str = "text",
        row_column: str | None = None,
    ) -> DataFrame:
        """Append the texts that are new and return one row for each row of ``docs``.

        Columns: row (``row_column``, or else the number of the row in this call), doc_id, digest, keep_id, group_size,
        kept. Of equal texts within the batch the row with the largest id stays (null is least; of repeated rows one
        stays); a text that an earlier batch brought keeps none. Null texts count as empty; an empty table gives no row;
        other columns are not read. Adding a batch again, split and ordered in any way, gives the same decisions and
        appends nothing.
        """
        known = self.table()
        rows = docs.select(
            (F.col(row_column) if row_column else F.monotonically_increasing_id()).alias("row"),
            F.col(id_column).cast("long").alias("doc_id"),
            text_digest(F.col(text_column)).alias("digest"),
        )
        rows = stored(rows, "digest-rows")
        found = rows.groupBy("digest").agg(
            F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("best"), F.count("*").alias("group_size")
        )
        found = found.select("digest", F.col("best.doc_id").alias("keep_id"), "group_size")
        fresh = found.join(known.hint("merge"), "digest", "left_anti").withColumn("batch", F.lit(batch))
        self._append(fresh.repartition(self.buckets, "digest"))
        seen = self.spark.table(self.name)
        # The row that stays is the first of this call with the text and its kept id: the key is even, also for hot texts.
        own = seen.where(F.col("batch") == batch).select(F.col("digest").alias("own"), F.col("keep_id").alias("own_id"))
        first = rows.join(own, (F.col("digest") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
        first = first.groupBy("digest").agg(F.min("row").alias("first"))
        decided = seen.join(first, "digest", "left").select("digest", "keep_id", "group_size", "first")
        return rows.join(decided.hint("merge"), "digest").select(
            "row", "doc_id", "digest", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("first"), F.lit(False)).alias("kept")
        )

    def compacted(self, buckets: int | None = None) -> DigestIndex:
        """The same index in a table of its own, each bucket one sorted file; appends leave a file for each batch.

        The number of buckets follows the number of digests unless given. This table stays as it is: drop it when the
        new one is in use. A run that dies leaves this one as it was.
        """
        if buckets is None:
            buckets = fitting_buckets(self.table().count())
        path = scratch_path(self.spark, "digest-index")
        new = DigestIndex(self.spark, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets)
        new._append(self.table().repartition(buckets, "digest"))
        return new


def fitting_buckets(digests: int) -> int:
    """Number of buckets that holds each at about BUCKET_DIGESTS digests."""
    return max(LEAST_BUCKETS, -(-digests // BUCKET_DIGESTS))


def new_index(spark: SparkSession, digests: int = 0) -> DigestIndex:
    """An empty index of its own in the shared folder, with buckets for about ``digests`` texts."""
    path = scratch_path(spark, "digest-index")
    return DigestIndex(spark, path.rsplit("/", 1)[1].replace("-", "_"), path, fitting_buckets(digests))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when equal texts are dropped, unchanged; of repeated rows one stays."""
    number = "row"
    while number in docs.columns:
        number += "_"
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "digest-numbered")
    found = new_index(docs.sparkSession, rows.count()).add(rows, "only", row_column=number)
    stay = found.where("kept").select(F.col("row").alias(number))
    # Row numbers are unique, so the hash tables of a partition are even, and no text is sorted.
    return rows.join(stay.hint("shuffle_hash"), number, "left_semi").drop(number)
