"""Task documents un-nested: tasks, their parameters and their session properties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    codes_by_position,
    elements_of,
    explode_elements,
    flag01,
    json_text,
    open_keys,
    truthy,
    typed,
)
from ..schemas import (
    PARAMETER_FLAGS,
    PARAMETER_LISTS,
    PARAMETER_OBJECTS,
    PARAMETER_TEXTS,
    TABLES,
)
from .mappings import node, opened, text_or_node
from .stamps import run_stamp


_TASK_KEYS = ["name", "parameters", "sessionPropertiesList"]
_PROPERTY_KEYS = ["name", "value", "recommended"]


def derive_tasks(docs: DataFrame, run_ts, nested: str = "text") -> DataFrame:
    """One row per task document with a name; codes by position in the name.

    ``nested="node"`` leaves the nested lists parsed, for children derived in flight.
    """
    now = run_stamp(run_ts)
    documents = explode_elements(docs, "body", ["source_path"], lambda root: F.array(open_keys(root, _TASK_KEYS)))
    tasks = documents.filter(truthy(opened("name"))).withColumn("name", typed(opened("name")))
    wave, process = codes_by_position(F.col("name"))
    return tasks.select(
        "source_path",
        wave.alias("CodOnda"),
        process.alias("CodProcess"),
        "name",
        text_or_node("parameters", "[]", nested).alias("parameters"),
        text_or_node("sessionPropertiesList", "[]", nested).alias("sessionPropertiesList"),
        now.alias("Dt_Inserted"),
        now.alias("Dt_Updated"),
    )


def _elements(tasks: DataFrame, column: str, keys: list[str]) -> DataFrame:
    # Elements that are no objects carry nothing to read and are left out.
    items = explode_elements(
        tasks,
        column,
        ["CodOnda", "CodProcess", F.col("name").alias("task_name"), "Dt_Inserted"],
        lambda root: elements_of(root, keys=keys),
    )
    return items.filter(node().isNotNull())


def derive_task_parameters(tasks: DataFrame, run_ts) -> DataFrame:
    """One row per task parameter, in the column order of ``s_task_parameters``."""
    names = [*PARAMETER_TEXTS, *PARAMETER_OBJECTS, *PARAMETER_LISTS, *PARAMETER_FLAGS]
    items = _elements(tasks, "parameters", names)
    keys = {name: opened(name) for name in names}
    made = {"Dt_updated": run_stamp(run_ts)}
    made |= {k: typed(keys[k], default="") for k in PARAMETER_TEXTS}
    made |= {k: json_text(keys[k], "{}") for k in PARAMETER_OBJECTS}
    made |= {k: json_text(keys[k], "[]") for k in PARAMETER_LISTS}
    made |= {k: flag01(keys[k]) for k in PARAMETER_FLAGS}
    return items.select(
        *[made.get(c, F.col(c)).alias(c) for c in TABLES["s_task_parameters"].columns]
    )


def derive_task_properties(tasks: DataFrame, run_ts, inserted_from: str = "task") -> DataFrame:
    """One row per task session property.

    ``inserted_from`` takes the insert time from the ``task`` row or from the ``run``.
    """
    now = run_stamp(run_ts)
    return _elements(tasks, "sessionPropertiesList", _PROPERTY_KEYS).select(
        "CodOnda",
        "CodProcess",
        "task_name",
        typed(opened("name"), default="").alias("name"),
        typed(opened("value"), default="").alias("value"),
        flag01(opened("recommended")).alias("recommended"),
        (F.col("Dt_Inserted") if inserted_from == "task" else now).alias("Dt_Inserted"),
        now.alias("Dt_Updated"),
    )
