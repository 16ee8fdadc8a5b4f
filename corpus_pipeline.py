"""The corpus pipeline: quality rules, near-dedup, decontamination, PII, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and rereads it for the next stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm.common import load
from cabflow.llm.decontaminate import decontaminated
from cabflow.llm.mix_sources import mix
from cabflow.llm.near_dedup import deduplicated
from cabflow.llm.pii import redact
from cabflow.llm.quality_rules import kept_documents
from cabflow.session import shared_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base test and the learned rules keep."""
    return kept_documents(docs, load(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return deduplicated(docs, size=5)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, load(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each document when sources are mixed to their weights."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("mix_sources", mix_stage),
]

# The learned rules and the boosted trees of the stages cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    folder = shared_path(spark, f"corpus-{uuid.uuid4().hex}")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
