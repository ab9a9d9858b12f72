"""The training-data pipeline over ``documents``: each stage is one operator applied to all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annoframe.llm import bpe, lines, mixing, near, quality
from annoframe.llm.common import table
from annoframe.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules judge bad go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing is left."""
    return lines.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near.drop_near(docs, plain=True)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken to meet the target weights, some of them in two epochs, some not at all."""
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and the digests of ids and decoded text, a row per document and epoch."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: Byte-pair merges cannot be written in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    import uuid

    docs = table(spark, sf_dir, "documents")
    home = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
