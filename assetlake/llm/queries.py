"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    checks,
    fair_mix,
    fast_sketch,
    impact_search,
    invertible_sketch,
    kd_shards,
    passages,
    prefix_tokens,
    quality,
    quotations,
    repair,
    spaced_seeds,
    style_tree,
    toxicity,
)

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = toxicity.toxicity(docs, _table(spark, sf_dir, "labels"))
    return scores.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op2_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.kd_shards(_table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spaced_seeds.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op4_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = fair_mix.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op5_paragraph_minhash_banding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeats(_table(spark, sf_dir, "documents"))


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_order(_table(spark, sf_dir, "conversations"))


def op7_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(_table(spark, sf_dir, "pages"))


def op8_invertible_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invertible_sketch.fingerprints(_table(spark, sf_dir, "documents"))


def op9_prefix_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    path = tokenizer or public_tokenizers.path(TOKENIZER)
    counted = prefix_tokens.prefix_tokens(_table(spark, sf_dir, "documents"), path)
    counted = counted.select("doc_id", "n_bytes", prefix_tokens.n_tokens("prefix_tokens").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fast_sketch.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair.repair_report(conversations, repair.damaged(conversations))


def op12_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = impact_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op13_quadratic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scores.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        F.col("_quality").alias("score"),
        (F.col("_quality") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Query] = {
    "op1_noisy_channel_toxicity": op1_noisy_channel_toxicity,
    "op2_kd_tree_sharding": op2_kd_tree_sharding,
    "op3_spaced_seed_decontamination": op3_spaced_seed_decontamination,
    "op4_weighted_fair_mix": op4_weighted_fair_mix,
    "op5_paragraph_minhash_banding": op5_paragraph_minhash_banding,
    "op6_quotation_linking": op6_quotation_linking,
    "op7_site_style_tree": op7_site_style_tree,
    "op8_invertible_fingerprints": op8_invertible_fingerprints,
    "op9_prefix_token_counts": op9_prefix_token_counts,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_best_position_search": op12_best_position_search,
    "op13_quadratic_quality": op13_quadratic_quality,
}

CHECKS: dict[str, str] = {
    "op11_conversation_repair": checks.CONVERSATION_REPAIR,
    "op12_best_position_search": checks.RANKED_SEARCH,
}
