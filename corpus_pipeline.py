"""A training corpus from raw documents: quality rules, quality classifier, near copies, personal data, packing.

Each stage gets the rows its predecessor kept, written as Parquet and read again, and returns what goes on: all but the last
return the columns of `documents`. A stage's folder is deleted once the next one is written; the last one stays. Null and empty texts fail the quality rules. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import stages
from tickloom.session import drop_path, scratch_path

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("quality_classifier", stages.quality_classifier),
    ("near_copies", stages.near_copies),
    ("personal_data", stages.personal_data),
    ("packing", stages.packed),
]
# Training and smoothing, byte pair merges and the tagger are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
