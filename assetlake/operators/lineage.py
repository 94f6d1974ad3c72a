"""Where an adapter object comes from: adapter, transformation, content, connection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lineage(
    objects: DataFrame,
    adapters: DataFrame,
    transformations: DataFrame,
    content: DataFrame,
    connections: DataFrame,
) -> DataFrame:
    """One row per adapter object with its parents, those being NULL that are not known.

    Codes that are NULL are equal to each other, as names without codes have them.  All joins
    are equi-joins from the side of the objects, so the optimizer is free to broadcast by
    measured size and to split hot keys at run time.  Content is found by
    name; of several documents with one name and the same codes the last id is taken, so
    that copies do not multiply the rows.
    """
    codes = ["CodOnda", "CodProcess"]
    object_rows = objects.select(
        F.col("id").alias("object_id"), "id_data_adapter", "id_transf", "object_name",
        F.col("path").alias("object_path"), *codes,
    )
    adapter_rows = adapters.select(
        F.col("id").alias("id_data_adapter"), "id_transf", "connection_id",
        F.col("object_type").alias("adapter_type"), *codes,
    )
    transformation_rows = transformations.select(
        F.col("id").alias("id_transf"), F.col("name").alias("transformation_name"),
        "content_name", *codes,
    )
    content_rows = (
        content.groupBy(F.struct(F.col("name").alias("content_name"), *codes).alias("_key"))
        .agg(F.max("id").alias("content_id"))
        .select("content_id", "_key.*")
    )
    connection_rows = connections.select(
        F.col("id").alias("connection_id"), F.col("name").alias("connection_name"),
        F.col("type").alias("connection_type"),
    )
    joined = _join(object_rows, adapter_rows, ["id_data_adapter", "id_transf", *codes])
    joined = _join(joined, transformation_rows, ["id_transf", *codes])
    joined = _join(joined, content_rows, ["content_name", *codes])
    return joined.join(connection_rows, "connection_id", "left").select(
        "object_id", "object_name", "object_path", "id_data_adapter", "adapter_type",
        "id_transf", "transformation_name", "content_id", "content_name",
        "connection_id", "connection_name", "connection_type", *codes,
    )


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys of which NULL equals NULL."""
    other = right.select(*[F.col(c).alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    same = reduce(and_, [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys])
    return left.join(other, same, "left").drop(*[f"_right_{k}" for k in keys])
