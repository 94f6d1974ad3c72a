"""Mixing sources to target weights by weighted fair queueing.

Every source is put in a hashed order and, if its target is larger than its size, passed through
again.  A document copy finishes at the virtual time (words of its source so far) / (target of
the source); all copies are sorted by that time over the whole cluster and cut off at the total
budget, so every source has taken its target when the cut comes.  A document copy is taken whole
or not at all.

Targets: the sources, by code point and null last, weigh 5, 2, 1, 5, 2, 1, ... and share the
sum of all sizes; no target exceeds ``most`` times its source's size, what is over goes to the
other sources by weight until none is above.

Edge cases: a null or blank text has size 0 and takes nothing; a source of size 0 has target 0;
rows repeated under one doc_id, and rows without one, are mixed one by one; an empty table gives
an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored

from .ordering import ranked

WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """source, place, source_size and target of every source in ``sized`` (source, size)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source, read from a written table: the window below sees names and sums only
    sums = stored(sums, "sources")
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sums = sums.withColumn("place", place).withColumn("weight", weight)
    sums = stored(sums.withColumn("most", (most * F.col("source_size")).cast("double")), "weights")
    total, level, capped = sums.agg(F.sum("source_size")).first()[0] or 0, 0.0, None
    while True:
        is_capped = F.col("most") <= F.lit(level) * F.col("weight")
        n, fixed, free = sums.agg(
            F.count_if(is_capped), F.sum(F.when(is_capped, F.col("most"))), F.sum(F.when(~is_capped, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (total - (fixed or 0.0)) / free
    target = F.least("most", F.lit(level) * F.col("weight")) if free else F.col("most")
    return sums.select("source", "place", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: int = 17, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every row of ``docs``."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = stored(docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("text_key")), "sized")
    shares = stored(targets(sized, weights, most), "targets")
    same = sized["source"].eqNullSafe(shares["source"])
    placed = sized.join(shares, same).select(sized["*"], "place", "source_size", "target")
    placed = placed.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text_key"))
    queued = ranked(placed, ["place", "key", "doc_id"], ["size"], "queues")
    queued = stored(queued.withColumnRenamed("_rank", "row").withColumnRenamed("_run_size", "upto"), "queued")
    starts = queued.groupBy("place").agg(F.min(F.col("upto") - F.col("size")).alias("start"))
    turns = F.sequence(F.lit(0), F.ceil(F.col("target") / F.col("source_size")).cast("int") - 1)
    copies = (
        queued.where("size > 0")
        .join(starts, "place")
        .withColumn("turn", F.explode(turns))
        .withColumn(
            "finish", (F.col("turn") * F.col("source_size") + F.col("upto") - F.col("start")) / F.col("target")
        )
        .select("row", "size", "finish", "place")
    )
    budget = shares.agg(F.sum("target")).first()[0] or 0.0
    line = ranked(copies, ["finish", "place", "row"], ["size"], "finish")
    taken = line.where(F.col("_run_size") <= round(budget)).groupBy("row").agg(F.sum("size").alias("taken"))
    return queued.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "text_key"
    )
