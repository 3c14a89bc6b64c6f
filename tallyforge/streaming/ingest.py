"""Incremental ingest of landed CSV files, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.sources.feeds import INGESTED_AT, RESCUED, SOURCE_FILE, Feed
from tallyforge.sources.files import CSV_OPTIONS
from tallyforge.streaming.deliveries import Deliveries


# Files per micro-batch: a backlog is taken in steps, so a restart repeats one step.
MAX_FILES = 10_000


def landed_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int = MAX_FILES
) -> DataFrame:
    """Stream of rows from the files of ``path`` (folder/pattern), with ingest metadata.

    Every file counts, however old, but each name once, and a file whose header differs from ``schema`` stops the run;
    ``Deliveries`` takes new content under an old name and other columns. A line with the wrong number of cells is
    kept, with its full text in the rescue column.
    """
    folder, pattern = path.rsplit("/", 1)
    full = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    reader = spark.readStream.schema(full).options(
        **CSV_OPTIONS,
        enforceSchema="false",
        columnNameOfCorruptRecord=RESCUED,
        maxFilesPerTrigger=max_files,
        maxFileAge="36500d",
        pathGlobFilter=pattern,
    )
    return reader.csv(folder).select(
        *full.fieldNames(),
        F.current_timestamp().alias(INGESTED_AT),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
    )


def ingest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    max_files: int = MAX_FILES,
) -> None:
    """Append everything that landed since the last run, then stop.

    The checkpoint holds the list of files that were read, so a rerun after a
    crash neither repeats nor skips a file.
    """
    (
        landed_stream(spark, landing, schema, max_files)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )


def feed_deliveries(spark: SparkSession, feed: Feed, bronze_root: str) -> Deliveries:
    return Deliveries(spark, feed.raw_schema, f"{bronze_root.rstrip('/')}/{feed.bronze_table}")


def ingest_feed(
    spark: SparkSession,
    feed: Feed,
    landing_root: str,
    bronze_root: str,
    max_files: int = MAX_FILES,
) -> DataFrame:
    """Land what one feed has delivered since the last run and return its bronze rows so far."""
    deliveries = feed_deliveries(spark, feed, bronze_root)
    deliveries.land_waiting(landing_root.rstrip("/"), feed.glob, max_files)
    return deliveries.rows()


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Bronze rows, also where no file has landed yet."""
    full = T.StructType(
        [
            *schema.fields,
            T.StructField(RESCUED, T.StringType()),
            T.StructField(INGESTED_AT, T.TimestampType()),
            T.StructField(SOURCE_FILE, T.StringType()),
        ]
    )
    return spark.read.schema(full).parquet(path)
