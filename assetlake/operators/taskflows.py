"""Task-flow items shredded into ten tables with explodes and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import join_pairs, join_texts, text_or_empty, ts_from_xml
from ..schemas import TABLES

_ARRIVAL = ["_path", "_item"]
_DATES = ["CreationDate", "ModificationDate", "PublicationDate"]


def _or_empty(value: Column | str) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))


def shred_taskflows(items: DataFrame) -> dict[str, DataFrame]:
    """The ten task-flow tables of parsed items.

    Every frame also carries ``_path``, ``_item`` and ``_pos`` for last-writer-wins.
    Items without an entry id and error rows are left out.
    """
    base = items.select(
        F.col("source_path").alias("_path"),
        F.col("pos").alias("_item"),
        "server_time",
        "item",
        text_or_empty(F.col("item.EntryId")).alias("EntryId"),
    ).filter(F.col("EntryId") != "")

    plain = [c for c in TABLES["Item"].columns if c not in ("EntryId", "CurrentServerDateTime")]
    item = base.select(
        *_ARRIVAL,
        F.lit(0).alias("_pos"),
        "EntryId",
        *[
            (ts_from_xml if c in _DATES else text_or_empty)(F.col("item")[c]).alias(c)
            for c in plain
        ],
        ts_from_xml(F.col("server_time")).alias("CurrentServerDateTime"),
    )

    flows = base.select(*_ARRIVAL, "EntryId", F.col("item.Entry.taskflow").alias("t")).filter(
        F.col("t").isNotNull()
    )
    entry = flows.select(
        *_ARRIVAL,
        F.lit(0).alias("_pos"),
        "EntryId",
        _or_empty("t.displayName").alias("DisplayName"),
        _or_empty("t.name").alias("EntryName"),
        F.coalesce(F.lower("t.overrideAPIName") == "true", F.lit(False))
        .cast("int")
        .alias("OverrideAPIName"),
        text_or_empty(F.col("t.description")).alias("Description"),
        text_or_empty(F.col("t.tags")).alias("Tags"),
        text_or_empty(F.col("t.generator")).alias("Generator"),
    )

    def exploded(source: DataFrame, array: str, *keep: str) -> DataFrame:
        return source.select(
            *_ARRIVAL, "EntryId", *keep, F.posexplode(array).alias("_pos", "x")
        )

    fields = exploded(flows, "t.fields").select(
        *_ARRIVAL,
        "_pos",
        "EntryId",
        _or_empty("x.description").alias("Description"),
        _or_empty("x.name").alias("Name"),
        _or_empty("x.type").alias("Type"),
        join_pairs(F.col("x.options"), "name", "text").alias("Options"),
    )

    def on(name: str) -> Column:
        return F.coalesce(F.col(name) == "true", F.lit(False)).cast("int")

    deployment = flows.filter(F.col("t.deployment").isNotNull()).select(
        *_ARRIVAL,
        F.lit(0).alias("_pos"),
        "EntryId",
        on("t.deployment.skipIfRunning").alias("SkipIfRunning"),
        on("t.deployment.suspendOnFault").alias("SuspendOnFault"),
        text_or_empty(F.col("t.deployment.tracingLevel")).alias("TracingLevel"),
        join_texts(F.col("t.deployment.groups.text")).alias("AllowedGroups"),
    )
    with_flow = flows.select(*_ARRIVAL, "EntryId", F.col("t.flow").alias("f")).filter(
        F.col("f").isNotNull()
    )
    flow = with_flow.select(
        *_ARRIVAL,
        F.lit(0).alias("_pos"),
        "EntryId",
        _or_empty("f.id").alias("FlowId"),
        _or_empty("f.start.id").alias("StartId"),
        _or_empty("f.start.link.targetId").alias("StartTargetId"),
    )

    # Services sit two lists deep; their place in the flow is container and index.
    containers = with_flow.select(
        *_ARRIVAL, "EntryId", F.posexplode("f.containers").alias("_container", "c")
    )
    services = containers.select(
        *_ARRIVAL, "EntryId", "_container", F.posexplode("c.services").alias("_service", "s")
    ).select(
        *_ARRIVAL,
        "EntryId",
        F.struct("_container", "_service").alias("_pos"),
        _or_empty("s.id").alias("ServiceId"),
        "s",
    )
    service = services.select(
        *_ARRIVAL,
        "_pos",
        "EntryId",
        "ServiceId",
        text_or_empty(F.col("s.title")).alias("Title"),
        text_or_empty(F.col("s.serviceName")).alias("ServiceName"),
        text_or_empty(F.col("s.serviceGUID")).alias("ServiceGUID"),
    )

    def below(source: DataFrame, array: str, *keep: str) -> DataFrame:
        deeper = source.select(
            *_ARRIVAL,
            F.col("_pos").alias("_outer"),
            "EntryId",
            "ServiceId",
            *keep,
            F.posexplode(array).alias("_inner", "x"),
        )
        return deeper.withColumn("_pos", F.struct("_outer", "_inner")).drop("_outer", "_inner")

    parameters = below(services, "s.inputs").withColumn("ParameterName", _or_empty("x.name"))
    inputs = parameters.select(
        *_ARRIVAL,
        "_pos",
        "EntryId",
        "ServiceId",
        "ParameterName",
        _or_empty("x.source").alias("Source"),
        _or_empty("x.text").alias("Value"),
    )

    def operation_columns() -> list[Column]:
        return [
            _or_empty("x.source").alias("OperationSource"),
            _or_empty("x.to").alias("OperationTarget"),
            _or_empty("x.text").alias("Value"),
        ]

    operations = below(
        parameters.withColumnRenamed("x", "p"), "p.operations", "ParameterName"
    ).select(
        *_ARRIVAL, "_pos", "EntryId", "ServiceId", "ParameterName", *operation_columns()
    )
    outputs = below(services, "s.outputs").select(
        *_ARRIVAL, "_pos", "EntryId", "ServiceId", *operation_columns()
    )
    dependencies = exploded(flows, "t.dependencies").select(
        *_ARRIVAL, "_pos", "EntryId", _or_empty("x.name").alias("ProcessObject")
    )
    return {
        "Item": item,
        "Entry": entry,
        "TempFields": fields,
        "Deployment": deployment,
        "Flow": flow,
        "Service": service,
        "ServiceInput": inputs,
        "ServiceOperation": operations,
        "ServiceOutput": outputs,
        "Dependencies": dependencies,
    }


TASKFLOW_ORDER = [*_ARRIVAL, "_pos"]
