"""Packages picked up as they arrive, with a file stream that stops when all are read.

The same load runs on every micro-batch.  Loads are upserts, so a batch that is repeated
after a failure gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import split_rejects
from ..sources.archives import unzip_members
from ..sources.documents import flag_bad_json

_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_archives(spark: SparkSession, path: str, suffix: str, ending: str) -> DataFrame:
    """New packages below ``path`` as a stream of documents."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return flag_bad_json(unzip_members(files, suffix, ending))


def load_arrivals(
    documents: DataFrame,
    load: Callable[[DataFrame], object],
    keep_rejects: Callable[[DataFrame], object],
    checkpoint: str,
) -> StreamingQuery:
    """Runs ``load`` on the usable new documents until none is left.

    ``keep_rejects`` gets the documents of every batch that failed, with their ``error``.
    """

    def on_batch(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            good, rejects = split_rejects(batch)
            load(good)
            keep_rejects(rejects)
        finally:
            batch.unpersist()

    return (
        documents.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
