"""Ranks and running totals along a global order, without sending all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.sources.scratch import stored


def ranked(df: DataFrame, keys: Sequence[str], totals: Sequence[str] = (), name: str = "ranked") -> DataFrame:
    """Adds ``_rank`` (from 0) along ``keys`` and, for each total, its running sum ``_run_<total>``.

    The rows are dealt by ranges of the keys and written once; each range is then numbered by
    itself and shifted by what the ranges before it hold (one small row per range).  Equal keys
    are told apart by a row number, so that many equal rows don't end in one range.  NULL keys
    come first, an empty frame stays empty.
    """
    order = [*keys, "_tie"]
    dealt = stored(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id()),
        name,
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(t).alias(f"_sum_{t}") for t in totals]
    )
    shifts = shifts.select(
        "_range",
        _so_far("_n", before).alias("_shift"),
        *[_so_far(f"_sum_{t}", before).alias(f"_shift_{t}") for t in totals],
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # one row per range of the shuffle: bounded by the number of shuffle partitions
    return (
        dealt.join(F.broadcast(shifts), "_range")
        .withColumn("_rank", F.count(F.lit(1)).over(inside) - 1 + F.col("_shift"))
        .withColumns({f"_run_{t}": F.sum(t).over(inside) + F.col(f"_shift_{t}") for t in totals})
        .drop("_tie", "_range", "_shift", *[f"_shift_{t}" for t in totals])
    )


def _so_far(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))
