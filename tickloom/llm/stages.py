"""The stages of the corpus pipeline: one operator each, on all documents that came so far."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import kneser_ney, pii, simhash_links, tier_packing, weak_quality
from tickloom.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return kneser_ney.keep_quality(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return weak_quality.keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies, in order of `doc_id`, then of arrival.

    Rows get a number before they are stored, so equal rows and null ids are told apart.
    """
    path = scratch_path(spark, "numbered")
    names = [f"c{i}" for i in range(len(docs.columns))]
    order = F.coalesce(F.col(names[docs.columns.index("doc_id")]).cast("long"), F.lit(2**63 - 1))
    docs.toDF(*names).select(*names, F.struct(order.alias("id"), F.monotonically_increasing_id().alias("row")).alias("key")).write.parquet(path)
    numbered = spark.read.parquet(path)
    text = names[docs.columns.index("text")]
    grouped = simhash_links.link_documents(numbered.select("key", F.col(text).alias("text")), "key", max_bits=4, shingle=4)
    first = grouped.where(F.col("key") == F.col("component")).select("key")
    return numbered.join(first, "key", "left_semi").select(*names).toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and `n_chars`, if there, counted anew."""
    cleaned = pii.redact(docs, pii.train_tagger(docs))
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in packed sequences."""
    return tier_packing.pack_documents(docs, TOKENIZER)
