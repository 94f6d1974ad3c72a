"""From raw documents to mixed and sharded training text, one operator per stage.

Each stage gets what the stage before it wrote and returns rows with the columns of ``documents``;
the last one returns the place of every row.  ``run`` writes each result to the shared folder and
reads it back, so a lost executor repeats part of one stage only.

A repeated row (one doc_id, one text) is one document: from the mixing on, its rows are as many as
the mix takes.  Rows with a null doc_id take part; documents without words leave with the mixing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm import fair_mix, fast_sketch, kd_shards, spaced_seeds, toxicity
from assetlake.sources.scratch import stored

SHARD_BYTES = 16 << 20
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(docs, labels).where("_toxicity < 0.5").drop("_toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8)."""
    found = fast_sketch.near_duplicates(docs)
    stays = found.where("stays").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("_key"))
    return docs.join(stays, same, "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return spaced_seeds.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = fair_mix.mix(docs).where("taken > 0").groupBy("doc_id", "source", "text_key")
    mixed = mixed.agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("_times"))
    mixed = mixed.toDF("_id", "_source", "_key", "_times")
    columns = docs.columns
    docs = docs.withColumn("_row_key", F.xxhash64("text"))
    docs = docs.dropDuplicates(["doc_id", "source", "_row_key"])
    same = docs["doc_id"].eqNullSafe(mixed["_id"]) & docs["source"].eqNullSafe(mixed["_source"]) & (docs["_row_key"] == mixed["_key"])
    taken = docs.join(mixed, same).withColumn("_time", F.explode(F.sequence(F.lit(1), "_times")))
    return taken.select(*columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    return kd_shards.kd_shards(docs, target_bytes=SHARD_BYTES).drop("row")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The toxicity model and the verification of near duplicates have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
