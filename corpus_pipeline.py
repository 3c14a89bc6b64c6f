"""Corpus pipeline: toxicity, exact copies, near copies, benchmark leaks, then token ids; each stage written as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import stages
from tallyforge.llm.corpus import documents
from tallyforge.session import scratch_path

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("exact_dedup", stages.drop_copies),
    ("jaccard_join", stages.drop_near_copies),
    ("decontamination", stages.drop_contaminated),
    ("bpe", stages.encode_all),
]

# The learned stages have no SQL counterpart; tests hold the rows against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
