"""Reading the relational test tables and spreading small ones over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str, deal: tuple[int, int] | None) -> DataFrame:
    """The rows of one deal, given by its number and how many there are; all without one.

    Rows of one key are in one deal, and every row is in one.
    """
    if deal is None or deal[1] == 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(key), F.lit(deal[1])) == deal[0])


def spread(df: DataFrame) -> DataFrame:
    """Evens out the rows before CPU-heavy building of documents from them.

    The rows are a fraction of the documents, so the shuffle is small beside what follows.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
