"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, best_fit, filter_audit, html_text, jaccard, lengths, maxscore, mixing, packing, pii, quality, sharding, suffix_tree
from .common import table

SHARDS = [f"shard-{i:03d}" for i in range(64)]
Query = Callable[[SparkSession, str], DataFrame]


def op1_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_shard_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)
    return placed.select("row.doc_id", "slot", "shard")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.totals(lengths.histogram(table(spark, sf_dir, "documents")))


def op6_disguised_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select(F.col("key").alias("doc_id"), *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    took = mixing.take(table(spark, sf_dir, "documents"))
    return took.withColumnRenamed("key", "doc_id")


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op10_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = filter_audit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counted)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def queries() -> dict[str, Query]:
    return {
        "op1_maxscore_top_k": op1_maxscore_top_k,
        "op2_main_text": op2_main_text,
        "op3_shard_placement": op3_shard_placement,
        "op4_quality_rules": op4_quality_rules,
        "op5_token_lengths": op5_token_lengths,
        "op6_disguised_pii": op6_disguised_pii,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_source_mix": op8_source_mix,
        "op9_harmonic_packing": op9_harmonic_packing,
        "op10_suffix_tree_score": op10_suffix_tree_score,
        "op11_token_alignment": op11_token_alignment,
        "op12_filter_audit": op12_filter_audit,
        "op13_best_fit_packing": op13_best_fit_packing,
    }
