"""Stages of the corpus pipeline: each takes documents and returns those that stay, with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import toxicity
from tallyforge.llm.digest_index import deduplicate
from tallyforge.llm.jaccard_join import keep_one_of_each_group
from tallyforge.llm.prefix_bpe import encoded_digests
from tallyforge.llm.templates import decontaminate


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under one half."""
    model = toxicity.train(docs.select("doc_id", "text"), toxicity.labelled_rows(spark, sf_dir))
    return toxicity.score(docs, model).where(F.col("toxicity") < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return deduplicate(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest id."""
    return keep_one_of_each_group(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def encode_all(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the text decoded from them, for each document."""
    return encoded_digests(docs)
