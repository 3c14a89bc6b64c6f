"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time sizing: it merges small shuffle
# partitions, splits skewed join partitions and turns a join into a broadcast
# once the measured side is below the threshold.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # No Python call site per column: plans of many columns are built faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    cores: int | str = 8, app: str = "tallyforge", conf: dict | None = None
) -> SparkSession:
    """Session for tests and single-node benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (local mode) is a temporary folder of our own made and remembered in the
    session, so that later calls find the same one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    remembered = spark.conf.get("tallyforge.local.scratch", None)
    if remembered:
        return remembered
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tallyforge-")
    spark.conf.set("tallyforge.local.scratch", made)
    return made


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def stored(parts: Sequence[DataFrame], purpose: str) -> Iterator[DataFrame]:
    """The rows of all parts, in the shared folder until the block ends.

    The parts are written one after the other, so only one of them has its shuffle files on disk.
    """
    spark = parts[0].sparkSession
    path = scratch_path(spark, purpose)
    try:
        with brief_shuffles(spark):
            for part in parts:
                part.write.mode("append").option("compression", "zstd").parquet(path)
        yield spark.read.parquet(path)
    finally:
        remove(spark, path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run in the block delete their shuffle files as they end.

    Otherwise these go when the driver's memory is collected, which a driver with much of it may do after hours. A frame
    that runs again shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(spark: SparkSession, folders: Iterable[str]) -> int:
    paths = [spark._jvm.org.apache.hadoop.fs.Path(folder) for folder in folders]
    conf = spark._jsc.hadoopConfiguration()
    return sum(path.getFileSystem(conf).getContentSummary(path).getLength() for path in paths)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a place to write when none is set yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))
