"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    byte_shards,
    kneser_ney,
    license_templates,
    merkle_manifest,
    piece_codec,
    pii,
    pruned_graph,
    repeat_tree,
    simhash_links,
    tier_packing,
    token_alignment,
    url_templates,
    weak_quality,
)
from tickloom.llm.common import table
from tickloom.llm.pii_base import KINDS

Query = Callable[[SparkSession, str], DataFrame]
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _text_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_codec.encode_pieces(_text_only(spark, sf_dir), PIECE_MODEL)
    covered = F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0), lambda x, y: x + y)
    digests = encoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        covered.cast("long").alias("covered_bytes"),
    )
    decoded = piece_codec.decode_pieces(digests, PIECE_MODEL)
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), "covered_bytes"
    )


def _span_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _text_only(spark, sf_dir)
    found = pii.find_pii(docs, pii.train_tagger(docs))
    base = F.filter("spans", lambda s: s.by_rule)
    kinds = F.transform(base, lambda s: s.kind)
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_span_text(base), 256).alias("base_sha256"), _span_text(F.col("spans")).alias("spans")
    )


def op3_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify_quality(_text_only(spark, sf_dir))


def op4_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return kneser_ney.judge_quality(docs)


def op5_simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash_links.link_documents(_text_only(spark, sf_dir), shingle=4, max_bits=4)
    printed = simhash_links.as_hex(F.col("fingerprint")).alias("fingerprint")
    return grouped.select("doc_id", printed, F.col("component").alias("component_id"))


def op6_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tier_packing.pack_documents(_text_only(spark, sf_dir), BYTE_TOKENIZER)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "tier",
        "step_group",
    )


def op7_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def op8_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = byte_shards.shard_by_bytes(_text_only(spark, sf_dir), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return pruned_graph.nearest(vectors, F.col("vec_id") % 50 == 0, 5)


def op10_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_templates.scan_licenses(_text_only(spark, sf_dir))
    base = F.filter("places", lambda p: p.by_phrase)
    starts = F.transform(base, lambda p: p.first_word)

    def labels(places: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p.label))))

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        "score",
    )


def proofs_of(docs: DataFrame) -> DataFrame:
    """Proofs of all documents; some claim one character too many."""

    def digest(n_chars: Column) -> Column:
        return merkle_manifest.digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = F.when(altered, digest(F.col("n_chars") + 1)).otherwise(digest(F.col("n_chars")))
    proven = merkle_manifest.prove_rows(docs, "doc_id", "lang", digest(F.col("n_chars")), claimed)
    return proven.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proofs_of(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(_text_only(spark, sf_dir), BYTE_TOKENIZER, PIECE_MODEL)


def op13_repeat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeat_tree.remove_repeats(_text_only(spark, sf_dir), size=50)
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def llm_queries() -> dict[str, Query]:
    return {
        q.__name__: q
        for q in (
            op1_piece_codec,
            op2_personal_data,
            op3_weak_quality,
            op4_perplexity_rules,
            op5_simhash_links,
            op6_tier_packing,
            op7_url_templates,
            op8_byte_shards,
            op9_pruned_graph,
            op10_license_templates,
            op11_merkle_manifest,
            op12_token_alignment,
            op13_repeat_tree,
        )
    }
