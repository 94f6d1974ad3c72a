"""Connected components of a graph of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node in ``pairs`` (a, b: longs); component is the least node reachable.

    Alternates large stars and small stars: each node hands its neighbours to the least of them,
    until every component is one star.  Each round is a partial minimum and a join on plain
    keys, written to the shared folder, so a hot centre is never collected in one task and the
    lineage stays short.
    """
    links = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stored(links.where("u <> v").distinct(), name)
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.union(lower.select("u", F.col("m").alias("v"))).distinct(), name)
        before, state = state, _state(links)
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select("v", "v").distinct()
            )


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
