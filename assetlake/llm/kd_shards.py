"""Sharding by a k-d tree over metadata.

Every document is a point: its size, its number, and its language and source as codes.  A node of
the tree that is to become k shards is cut along the dimension in which it is widest (against
the whole table), at the weighted median: so that the lower part holds floor(k / 2) / k of the
node's bytes.  Cutting goes on until a leaf is one shard of about the target bytes.

The medians of all nodes of a level are found together: bytes are summed in BUCKETS equal slices
of each node's range, the slice that holds the median becomes the range of the next pass, until
it holds one value.  Only sums leave the tasks; the number of rows a pass gathers is nodes times
BUCKETS, whatever the input.  Equal values are told apart by a hash of the document, so a value
shared by a third of all rows can be cut too.

Edge cases: a null text has size ``overhead``; null metadata counts as the least value; rows that
are equal in everything are told apart by a row number; an empty table gives no shards.  Other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .ordering import ranked

BUCKETS = 1024
DIMENSIONS = ("by_size", "by_id", "by_lang", "by_source")
_WIDE = 2**31 - 1


def points(docs: DataFrame, overhead: int = 16) -> DataFrame:
    """One row per document: what the tree needs, without the text."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + overhead
    crc = F.crc32(F.col("text").cast("binary"))
    rows = docs.select(
        "doc_id",
        size.alias("size"),
        crc.alias("text_crc32"),
        F.log2(size).alias("size_log"),
        F.coalesce(F.crc32(F.col("lang").cast("binary")), F.lit(-1)).alias("lang_code"),
        F.coalesce(F.crc32(F.col("source").cast("binary")), F.lit(-1)).alias("source_code"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "points")
    lows = {"by_size": "size_log", "by_id": "doc_id", "by_lang": "lang_code", "by_source": "source_code"}
    ends = rows.agg(*[f(F.col(c).cast("double")).alias(n + d) for d, c in lows.items() for n, f in (("lo_", F.min), ("hi_", F.max))])
    ends = ends.first()
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "row"), 33)  # 31 bits

    def scaled(name: str, column: str) -> Column:
        lo, hi = ends[f"lo_{name}"] or 0.0, ends[f"hi_{name}"] or 0.0
        value = (F.coalesce(F.col(column).cast("double"), F.lit(lo)) - lo) / max(hi - lo, 1e-9)
        return F.shiftleft(F.floor(value * _WIDE).cast("long"), 31) + tie

    return rows.select("doc_id", "size", "text_crc32", "row", *[scaled(d, c).alias(d) for d, c in lows.items()])


def _split(rows: DataFrame, level: int) -> DataFrame:
    """One cut of every node (leaf, k) with k > 1: the lower part keeps ``leaf``."""
    open_rows = rows.where("k > 1")
    widths = F.array(*[F.struct((F.max(d) - F.min(d)).alias("w"), F.lit(-i).alias("i")) for i, d in enumerate(DIMENSIONS)])
    ends = F.array(*[F.struct(F.min(d).alias("lo"), F.max(d).alias("hi")) for d in DIMENSIONS])
    nodes = open_rows.groupBy("leaf", "k").agg(F.sum("size").alias("bytes"), widths.alias("widths"), ends.alias("ends"))
    nodes = nodes.withColumn("dim", -F.array_max("widths")["i"])
    lower = F.floor(F.col("k") / 2).cast("int")
    nodes = nodes.select(
        "leaf",
        "dim",
        lower.alias("lower"),
        F.element_at("ends", F.col("dim") + 1)["lo"].alias("lo"),
        F.element_at("ends", F.col("dim") + 1)["hi"].alias("hi"),
        (F.col("bytes") * lower / F.col("k")).alias("goal"),
        F.lit(0).cast("long").alias("below"),
        F.lit(0).cast("long").alias("inside"),
    )
    nodes = stored(nodes, "nodes")
    # at most one row per shard, and the number of shards is a parameter: fit for a broadcast
    value = F.element_at(F.array(*DIMENSIONS), F.col("dim") + 1)
    while nodes.where("lo < hi").limit(1).count():
        busy = nodes.where("lo < hi")
        step = F.floor((F.col("value") - F.col("lo")) / F.greatest(F.lit(1), F.floor((F.col("hi") - F.col("lo")) / BUCKETS) + 1))
        sums = (
            open_rows.join(F.broadcast(busy), "leaf")
            .withColumn("value", value)
            .where("value between lo and hi")
            .groupBy("leaf", step.alias("slice"))
            .agg(F.sum("size").alias("bytes"), F.min("value").alias("slice_lo"), F.max("value").alias("slice_hi"))
        )
        upto = F.sum("bytes").over(Window.partitionBy("leaf").orderBy("slice"))  # BUCKETS rows per node
        sums = sums.withColumn("upto", upto)
        found = sums.join(F.broadcast(busy), "leaf").where("below + upto >= goal or slice_hi = hi")
        found = found.groupBy("leaf").agg(F.min_by(F.struct("slice_lo", "slice_hi", "bytes", "upto"), "slice").alias("s"))
        found = busy.join(found, "leaf").select(
            "leaf",
            "dim",
            "lower",
            F.col("s.slice_lo").alias("lo"),
            F.col("s.slice_hi").alias("hi"),
            "goal",
            (F.col("below") + F.col("s.upto") - F.col("s.bytes")).alias("below"),
            F.col("s.bytes").alias("inside"),
        )
        nodes = stored(found.unionByName(nodes.where("lo = hi")), "nodes")
    # the document at the median goes where it leaves the smaller error
    first_above = F.when(F.col("below") + F.col("inside") - F.col("goal") <= F.col("goal") - F.col("below"), F.col("lo") + 1)
    cuts = nodes.select("leaf", "dim", "lower", first_above.otherwise(F.col("lo")).alias("cut"))
    cut = rows.join(F.broadcast(cuts), "leaf", "left")
    above = value >= F.col("cut")
    return stored(
        cut.select(
            *[c for c in rows.columns if c not in ("leaf", "k")],
            F.when(above, F.col("leaf") + F.col("lower")).otherwise(F.col("leaf")).alias("leaf"),
            F.when(F.col("cut").isNull(), F.col("k")).when(above, F.col("k") - F.col("lower")).otherwise(F.col("lower")).alias("k"),
        ),
        f"level{level}",
    )


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int = 1 << 30, overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, row, shard and slot of every row of ``docs`` (doc_id, text, lang, source).

    The number of shards is given or follows from ``target_bytes``; their sizes in bytes are near equal.
    """
    rows = points(docs, overhead)
    if shards is None:
        shards = max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    rows = rows.withColumns({"leaf": F.lit(0), "k": F.lit(shards)})
    for level in range((shards - 1).bit_length()):
        rows = _split(rows, level)
    placed = rows.select("doc_id", "size", "text_crc32", "row", F.col("leaf").alias("shard"))
    numbered = stored(ranked(placed, ["shard", "doc_id", "row"], name="slots"), "numbered")
    first = numbered.groupBy("shard").agg(F.min("_rank").alias("first"))  # one row per shard
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "row", "shard", (F.col("_rank") - F.col("first")).alias("slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Writes the rows of ``docs`` (with one row per doc_id) below ``path``, a folder for each shard."""
    with_shard = docs.join(placed.select("doc_id", "shard"), "doc_id")
    with_shard.repartition("shard", F.spark_partition_id() % 8).write.partitionBy("shard").parquet(path)
