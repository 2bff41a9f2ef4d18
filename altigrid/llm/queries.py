"""Registered queries of the training-data operators, each over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from altigrid.llm import (
    hard_negatives, jaccard_join, mixing, packing, page_differencing, preferences, quality, suffix_dedup, token_frames, topk, toxicity, warc, whitening,
)
from altigrid.llm.common import scratch, table
from altigrid.llm.oracles import llm_oracles


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page: links, digests and sizes."""
    records = warc.derive(warc.page_responses(table(spark, sf_dir, "pages")))
    return records.select(
        "warc_type", "record_id", "refers_to", "target_uri", "content_type", "block_digest", "source_block_digest", "source_payload_digest",
        F.octet_length("block").cast("long").alias("n_bytes"), F.octet_length("record").cast("long").alias("n_record_bytes"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with the last reply of the next one."""
    pairs = preferences.swapped_replies(table(spark, sf_dir, "conversations"))
    return preferences.format_pairs(pairs).withColumnRenamed("pair_id", "conv_id")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op6_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_differencing.main_text(table(spark, sf_dir, "pages"))


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a mix that favours small sources: block of the mix and place in it."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"))
    return mixed.select("doc_id", "source", F.col("_slot").alias("slot"), F.col("_place").alias("place"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: vec_id divisible by 100. Candidates: all other rows."""
    vectors = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "embedding AS v")
    return topk.top_k(vectors, vectors.where("id % 100 = 0"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all texts as token files, read the files back."""
    path = f"{scratch(spark)}/tokens-{uuid.uuid4().hex}"
    token_frames.write_tokens(table(spark, sf_dir, "documents"), path, packing.vocabulary())
    return token_frames.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: vec_id divisible by 100. Where it is divisible by 7, the label moves on by one."""
    label = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("v"))
    return hard_negatives.hard_negatives(rows, F.expr("id % 100 = 0"))


def llm_queries() -> dict:
    every = (
        op1_warc_derivatives, op2_toxicity, op3_best_fit_packing, op4_preferences, op5_jaccard_join, op6_page_differencing,
        op7_pfair_mixing, op8_exact_top_k, op9_suffix_dedup, op10_quality_rules,
        op11_token_frames, op12_whitening, op13_hard_negatives,
    )
    return {f.__name__: f for f in every}

