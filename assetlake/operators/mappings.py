"""Mapping documents un-nested: content, transformations, properties, adapters, objects.

Each step takes the frame of its parent.  Nested JSON columns may be text or VARIANT: with
``nested="node"`` (in flight) or ``nested="stored"`` (for tables with VARIANT columns, where an
absent key is its default) a whole chain parses every document once.
``_pos`` is the place in the parent's array and ``_content`` the id of the parent document, for
last-writer-wins.

An element's keys are opened in one pass inside the generator, as the struct ``_node``.  Rows
without an id are filtered directly on it, above the generator: there the filter cannot be
pushed below the parse and make it run twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    brazil_time,
    class_int,
    codes_by_position,
    elements_of,
    explode_elements,
    first_object,
    flag_text,
    input_sorted_text,
    is_true_literal,
    json_or_default,
    json_text,
    member,
    open_keys,
    truthy,
    ts_from_iso,
    typed,
    value_to_string,
)
from ..functions.times import DEFAULT_TIMESTAMP
from .stamps import run_stamp

_CODES = ["CodOnda", "CodProcess"]


def node() -> Column:
    """The current JSON element."""
    return F.col("_node")


def require_id(df: DataFrame, key: str) -> DataFrame:
    """Elements whose id key is there and not empty."""
    return df.filter(truthy(member(node(), key)))


def key(name: str) -> Column:
    """Node of a key of the current element; keys nobody selects are never read."""
    return member(node(), name)


def opened(name: str) -> Column:
    """Node of a key of the current element where its keys are opened."""
    return node().getField(name)


# The keys that are read of each kind of element.
_CONTENT_KEYS = [
    "$$IID", "$$class", "name", "annotations", "bigIntConvertType", "documentType", "ecoSystem",
    "templateOrigin", "links", "transformations", "variables",
]
_TRANSFORMATION_KEYS = [
    "$$ID", "$$class", "createTime", "annotations", "name", "inputSorted", "advancedProperties",
    "groups", "sessionProperties", "generateFilenamePort", "useLabels", "useSequenceFields",
    "fields", "dataAdapter",
]
_PROPERTY_KEYS = ["$$ID", "$$class", "name", "value"]
_ADAPTER_KEYS = [
    "$$ID", "$$class", "compatibleEngine", "connectionId", "excludeDynamicFileNameField",
    "fwConfigId", "multipleObject", "objectType", "typeSystem", "useDynamicFileName", "object",
    "oprRuntimeAttributes", "readOptions", "runtimeAttributes",
]
_OBJECT_KEYS = [
    "$$ID", "$$class", "name", "customQuery", "label", "objectName", "objectType", "parentPath",
    "path", "retainMetadata", "fields", "fileAttrs",
]


def text_or_node(name: str, default: str, nested: str) -> Column:
    """A nested key as JSON text, as it is (``nested="node"``), or as a node with its default (``"stored"``)."""
    if nested == "stored":
        return F.coalesce(opened(name), F.parse_json(F.lit(default)))
    return opened(name) if nested == "node" else json_text(opened(name), default)


def derive_content(docs: DataFrame, run_ts, nested: str = "text") -> DataFrame:
    """One row per document with a ``content`` object that has an id."""
    now = run_stamp(run_ts)
    # Exploding the single root keeps the id filter from being pushed below the parse.
    content = explode_elements(
        docs, "body", ["source_path"], lambda root: F.array(open_keys(member(root, "content"), _CONTENT_KEYS))
    )
    rows = content.filter(truthy(opened("$$IID"))).withColumn(
        "name", typed(opened("name"), default="")
    )
    wave, process = codes_by_position(F.when(F.col("name") != "", F.col("name")))
    return rows.select(
        "source_path",
        typed(opened("$$IID")).alias("id"),
        typed(opened("$$class"), default="").alias("class"),
        wave.alias("CodOnda"),
        process.alias("CodProcess"),
        text_or_node("annotations", "{}", nested).alias("annotations"),
        typed(opened("bigIntConvertType")).alias("big_int_convert_type"),
        typed(opened("documentType")).alias("document_type"),
        typed(opened("ecoSystem")).alias("eco_system"),
        "name",
        typed(opened("templateOrigin")).alias("template_origin"),
        text_or_node("links", "[]", nested).alias("links"),
        text_or_node("transformations", "[]", nested).alias("transformations"),
        text_or_node("variables", "{}", nested).alias("variables"),
        now.alias("Dt_Inserted"),
        now.alias("Dt_updated"),
    )


def derive_transformations(content: DataFrame, run_ts, nested: str = "text") -> DataFrame:
    """One row per element of ``content.transformations`` that has an id."""
    now = run_stamp(run_ts)
    items = explode_elements(
        content,
        "transformations",
        [F.col("id").alias("_content"), F.col("name").alias("content_name"), *_CODES],
        lambda root: elements_of(root, keys=_TRANSFORMATION_KEYS),
    )
    rows = items.filter(truthy(opened("$$ID"))).withColumn("create_time", ts_from_iso(typed(opened("createTime")), DEFAULT_TIMESTAMP))
    return rows.select(
        typed(opened("$$ID")).alias("id"),
        typed(opened("$$class"), default="").alias("class"),
        text_or_node("annotations", "{}", nested).alias("annotations"),
        "create_time",
        brazil_time(F.col("create_time")).alias("create_time_brazil"),
        typed(opened("name"), default="").alias("name"),
        input_sorted_text(opened("inputSorted")).alias("inputSorted"),
        text_or_node("advancedProperties", "{}", nested).alias("advanced_properties"),
        text_or_node("groups", "[]", nested).alias("_groups"),
        text_or_node("sessionProperties", "{}", nested).alias("session_properties"),
        is_true_literal(opened("generateFilenamePort")).alias("generate_filename_port"),
        is_true_literal(opened("useLabels")).alias("use_labels"),
        is_true_literal(opened("useSequenceFields")).alias("use_sequence_fields"),
        text_or_node("fields", "[]", nested).alias("fields"),
        text_or_node("dataAdapter", "{}", nested).alias("data_adapter"),
        "content_name",
        *_CODES,
        now.alias("Dt_Inserted"),
        now.alias("Dt_updated"),
        "_content",
        "_pos",
    )


# Per property kind, the stored column, the wrapping key and the text of true.
_PROPERTY_KINDS = {
    "session": ("session_properties", "sessionProperties", "title"),
    "advanced": ("advanced_properties", "advancedProperties", "json"),
}


def derive_properties(transformations: DataFrame, kind: str, run_ts) -> DataFrame:
    """One row per session or advanced property that has an id."""
    column, wrapper, bool_style = _PROPERTY_KINDS[kind]
    now = run_stamp(run_ts)
    items = explode_elements(
        transformations,
        column,
        [F.col("id").alias("id_transf"), *_CODES, "content_name", "create_time_brazil"],
        lambda root: elements_of(root, inner_key=wrapper, keys=_PROPERTY_KEYS),
    )
    rows = items.filter(truthy(opened("$$ID")))
    identifier = typed(opened("$$ID"))
    name = typed(opened("name"), default="")
    if kind == "advanced":
        name = F.when(truthy(opened("name")), name).otherwise(
            F.concat(F.lit("property_"), identifier)
        )
    return rows.select(
        identifier.alias("Id" if kind == "advanced" else "id"),
        "id_transf",
        typed(opened("$$class"), default="").alias("class"),
        name.alias("name"),
        value_to_string(opened("value"), bool_style).alias("value"),
        "content_name",
        *_CODES,
        F.coalesce("create_time_brazil", now).alias("Dt_Inserted"),
        now.alias("Dt_updated"),
        "_pos",
    )


def derive_data_adapters(transformations: DataFrame, run_ts, nested: str = "text") -> DataFrame:
    """The data adapter of every transformation that has one."""
    now = run_stamp(run_ts)
    adapters = first_object(
        transformations,
        "data_adapter",
        [F.col("id").alias("id_transf"), *_CODES, "content_name", "create_time_brazil"],
    )
    rows = adapters.withColumn("_node", open_keys(node(), _ADAPTER_KEYS))
    return rows.select(
        typed(opened("$$ID")).alias("id"),
        "id_transf",
        typed(opened("$$class"), default="").alias("_class"),
        typed(opened("compatibleEngine")).alias("compatible_engine"),
        typed(opened("connectionId")).alias("connection_id"),
        typed(opened("excludeDynamicFileNameField")).alias("exclude_dynamic_file_name_field"),
        typed(opened("fwConfigId")).alias("fw_config_id"),
        typed(opened("multipleObject")).alias("multiple_object"),
        typed(opened("objectType")).alias("object_type"),
        typed(opened("typeSystem")).alias("type_system"),
        typed(opened("useDynamicFileName")).alias("use_dynamic_file_name"),
        text_or_node("object", "{}", nested).alias("object"),
        text_or_node("oprRuntimeAttributes", "{}", nested).alias("opr_runtime_attributes"),
        text_or_node("readOptions", "{}", nested).alias("read_options"),
        text_or_node("runtimeAttributes", "{}", nested).alias("runtime_attributes"),
        "content_name",
        *_CODES,
        F.coalesce("create_time_brazil", now).alias("Dt_Inserted"),
        now.alias("Dt_updated"),
    )


def derive_adapter_objects(adapters: DataFrame, run_ts) -> DataFrame:
    """The object of every data adapter whose object has an id."""
    now = run_stamp(run_ts)
    objects = first_object(
        adapters,
        "object",
        [F.col("id").alias("id_data_adapter"), "id_transf", *_CODES, "content_name", "Dt_Inserted"],
    )
    rows = require_id(objects, "$$ID").withColumn("_node", open_keys(node(), _OBJECT_KEYS))
    return rows.select(
        typed(opened("$$ID")).alias("id"),
        "id_transf",
        "id_data_adapter",
        *_CODES,
        class_int(opened("$$class")).alias("class"),
        typed(opened("name"), default="").alias("name"),
        typed(opened("customQuery")).alias("custom_query"),
        typed(opened("label")).alias("label"),
        typed(opened("objectName")).alias("object_name"),
        typed(opened("objectType")).alias("object_type"),
        typed(opened("parentPath")).alias("parent_path"),
        typed(opened("path")).alias("path"),
        flag_text(opened("retainMetadata")).alias("retain_metadata"),
        json_or_default(opened("fields"), "[]").alias("fields"),
        json_or_default(opened("fileAttrs"), "{}").alias("file_attrs"),
        "content_name",
        F.coalesce("Dt_Inserted", now).alias("Dt_Inserted"),
        now.alias("Dt_updated"),
    )
