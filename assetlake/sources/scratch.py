"""Places for intermediate data that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session uses a folder below its warehouse; on a cluster there
    is no folder to guess, so the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/assetlake-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in a folder of this application."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def stored_together(frames: Iterable[DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """Frames of one schema, each written to the shared folder before the next is asked for, read back as one."""
    path = scratch_path(spark, name)
    for df in frames:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def remove_scratch(spark: SparkSession) -> None:
    """Removes all intermediate data of this application; its frames can't be read afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
