"""File records, connections, exported objects and package lists as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    brazil_time,
    codes_by_digits,
    codes_by_type,
    elements_of,
    explode_elements,
    federated_id,
    is_number,
    is_text_or_absent,
    json_or_null,
    json_text,
    member,
    strip_at,
    ts_from_iso,
    ts_from_millis,
    typed,
)
from ..functions.codes import PACKAGE_TYPES, VALID_WAVES
from .mappings import key, node
from .stamps import run_stamp

# The epoch milliseconds of years 1 to 9999.
_FIRST_MILLI, _LAST_MILLI = -62135596800000, 253402300799999


def document_records(
    docs: DataFrame, inner_key: str | None = None, own_kind: str | None = None
) -> DataFrame:
    """One row per record of every document: ``source_path``, ``_pos``, ``_node``."""
    return explode_elements(
        docs, "body", ["source_path"], lambda root: elements_of(root, inner_key, own_kind)
    )


def filter_kind(records: DataFrame, kind: str) -> DataFrame:
    """Records whose ``@type`` is ``kind``."""
    return records.filter(F.try_variant_get(node(), "$['@type']", "string") == kind)


def derive_file_records(docs: DataFrame) -> DataFrame:
    """File records with a numeric id and a usable time."""
    records = filter_kind(document_records(docs, "records", "fileRecord"), "fileRecord")
    rows = records.filter(is_text_or_absent(key("id")) & is_text_or_absent(key("name")))
    identifier = F.btrim(strip_at(typed(key("id"), default="0")))
    attach = key("attachTime")
    good = rows.select(
        "source_path",
        "_pos",
        F.when(identifier.rlike("^[+-]?[0-9]+$"), identifier.try_cast("bigint")).alias("id"),
        typed(key("name"), default="").alias("name"),
        typed(key("type"), default="").alias("type"),
        typed(key("size"), "bigint", 0).alias("size"),
        F.when(attach.isNull(), F.lit(0))
        .when(is_number(attach), attach.try_cast("bigint"))
        .alias("_millis"),
    ).filter(F.col("id").isNotNull() & F.col("_millis").between(_FIRST_MILLI, _LAST_MILLI))
    updated = ts_from_millis(F.col("_millis"))
    wave, process = codes_by_digits(F.col("name"))
    return good.select(
        "id",
        "name",
        "type",
        "size",
        updated.alias("updated_time"),
        brazil_time(updated).alias("updated_time_brazil"),
        wave.alias("CodOnda"),
        process.alias("CodProcess"),
        "source_path",
        "_pos",
    )


# Connection columns and the keys they are read from.
_CONNECTION_TEXTS = {
    "description": "description",
    "runtimeEnvironmentId": "runtimeEnvironmentId",
    "instanceDisplayName": "instanceDisplayName",
    "host": "host",
    "database_name": "database",
    "codepage": "codepage",
    "authenticationType": "authenticationType",
    "adjustedJdbcHostName": "adjustedJdbcHostName",
    "schema_name": "schema",
    "shortDescription": "shortDescription",
    "type": "type",
    "port": "port",
    "username": "username",
    "timeout": "timeout",
}
_CONNECTION_FLAGS = [
    "internal",
    "retryNetworkError",
    "supportsCCIMultiGroup",
    "metadataBrowsable",
    "supportLabels",
    "vaultEnabled",
]


def derive_connections(docs: DataFrame, mask_password: bool = True) -> DataFrame:
    """Connections; the password is masked unless asked for."""
    records = filter_kind(document_records(docs), "connection")
    rows = records.filter(is_text_or_absent(key("id"))).withColumn(
        "majorUpdateTime", ts_from_iso(typed(key("majorUpdateTime")))
    )
    password = typed(key("password"))
    if mask_password:
        password = F.when(password.isNotNull(), F.lit("***"))
    return rows.select(
        strip_at(typed(key("id"), default="")).alias("id"),
        typed(key("name"), default="").alias("name"),
        *[typed(key(k)).alias(column) for column, k in _CONNECTION_TEXTS.items()],
        password.alias("password"),
        "majorUpdateTime",
        brazil_time(F.col("majorUpdateTime")).alias("majorUpdateTime_brazil"),
        json_or_null(key("connParams")).alias("connParams"),
        federated_id(typed(key("federatedId"))).alias("federatedId"),
        *[typed(key(k), "boolean", False).alias(k) for k in _CONNECTION_FLAGS],
        json_or_null(key("vaultEnabledParams")).alias("vaultEnabledParams"),
        "source_path",
        "_pos",
    )


def derive_exported_objects(docs: DataFrame, project: Column, run_ts) -> DataFrame:
    """Exported objects that belong to the project of their document.

    A name without digits counts as the project's own; the name of another project
    drops the object.
    """
    items = explode_elements(
        docs,
        "body",
        [project.cast("string").alias("_project")],
        lambda root: member(root, "exportedObjects").try_cast("array<variant>"),
    )
    info = "metadata.additionalInfo"
    rows = items.withColumn("object_name", typed(key("objectName")))
    wave, process = codes_by_digits(F.col("object_name"))

    return (
        rows.withColumn("cod_projeto", F.coalesce(wave, F.col("_project")))
        .filter(F.col("cod_projeto") == F.col("_project"))
        .select(
            typed(key("objectGuid")).alias("object_guid"),
            "object_name",
            typed(key("objectType")).alias("object_type"),
            typed(key("path")).alias("path"),
            typed(key(f"{info}.description")).alias("description"),
            typed(key(f"{info}.contentType")).alias("content_type"),
            typed(key(f"{info}.documentState")).alias("document_state"),
            json_text(key(info), "{}").alias("additional_info_json"),
            "cod_projeto",
            process.alias("cod_processo"),
            run_stamp(run_ts).alias("created_at"),
        )
    )


def derive_package_contents(
    rows: DataFrame, run_ts, valid_waves: list[str] = VALID_WAVES
) -> DataFrame:
    """Package list rows of the kept object types, with integer codes."""
    now = run_stamp(run_ts)
    wave, process = codes_by_type(F.col("objectName"), F.col("objectType"), valid_waves)
    return rows.filter(F.col("objectType").isin(PACKAGE_TYPES)).select(
        "id",
        wave.alias("CodOnda"),
        process.alias("CodProcess"),
        "objectPath",
        "objectName",
        "objectType",
        now.alias("Dt_Inserted"),
        now.alias("Dt_updated"),
        *[c for c in ("source_path", "_pos") if c in rows.columns],
    )
