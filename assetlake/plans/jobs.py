"""The load jobs: staged documents or parent tables in, target tables out.

Packages are unzipped and checked once into staging tables.  Every job handles all waves
of a run in one pass and returns the number of rows written per table.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import PACKAGE_TYPES
from ..operators.assets import (
    derive_connections,
    derive_exported_objects,
    derive_file_records,
    derive_package_contents,
)
from ..operators.history import (
    current_batch,
    history_window,
    latest_batch,
    slice_of,
    snapshot_history,
)
from ..operators.mappings import (
    derive_adapter_objects,
    derive_content,
    derive_data_adapters,
    derive_properties,
    derive_transformations,
)
from ..operators.merge import collapse_batch, doomed_keys, fresh_rows, upsert_table, without_keys
from ..operators.quality import load_audit, naming_anomalies, naming_summary, split_rejects
from ..operators.stamps import run_stamp
from ..operators.standardize import apply_rename_rules, clean_columns, nan_to_null
from ..operators.taskflows import TASKFLOW_ORDER, shred_taskflows
from ..operators.tasks import derive_task_parameters, derive_task_properties, derive_tasks
from ..schemas import TABLES, TASKFLOW_TABLES
from ..sources.documents import json_error, wrapped_json
from ..sources.scratch import stored
from ..sources.store import TableStore

Written = dict[str, int]

# Staging table of every kind of document; each kind is a struct column in its table.
STAGED = {
    "maps": "stage_mappings",
    "file_records": "stage_mappings",
    "tasks": "stage_tasks",
    "connections": "stage_connections",
}


def stage_packages(store: TableStore, name: str, packages: DataFrame, more: bool = False) -> Written:
    """Keeps the members of unzipped packages as parsed documents, with their error, if any.

    One pass over the packages, in which each document is parsed once; loaders then read the
    column of their kind only.  With ``more``, what is staged already stays.
    """
    kinds = [kind for kind in STAGED if kind in packages.columns]
    # a column of its own, so that a document is parsed once for all that is said about it
    parsed = packages.withColumns({f"_{kind}": wrapped_json(F.col(kind).body) for kind in kinds})

    def checked(kind: str) -> Column:
        error = json_error(F.col(kind).body, F.col(kind).error, F.col(f"_{kind}"))
        document = F.when(error.isNull(), F.try_variant_get(f"_{kind}", "$[0]", "variant"))
        return F.struct(document.alias("body"), error.alias("error"))

    rows = parsed.withColumns({kind: checked(kind) for kind in kinds}).drop(*[f"_{kind}" for kind in kinds])
    return {name: _stage(store, name, rows, more)}


def _stage(store: TableStore, name: str, rows: DataFrame, more: bool) -> int:
    return store.append(name, rows) if more else store.overwrite(name, rows)


def stage_nothing(store: TableStore, name: str) -> Written:
    """An empty staging table: what a run could not stage is not there for its loads."""
    kinds = [kind for kind, table in STAGED.items() if table == name]
    columns = [f"{kind} struct<body variant, error string>" for kind in kinds]
    schema = ", ".join(["source_path string", "asset_name string", *columns])
    return {name: store.overwrite(name, store.spark.createDataFrame([], schema))}


def _staged(store: TableStore, kind: str) -> DataFrame:
    packages = store.read(STAGED[kind])
    return packages.select("source_path", "asset_name", f"{kind}.body", f"{kind}.error")


def staged(store: TableStore, kind: str) -> tuple[DataFrame, DataFrame]:
    """Usable and rejected documents of one kind."""
    return split_rejects(_staged(store, kind))


def keep_counters(store: TableStore, outcomes: DataFrame, run_ts) -> int:
    """Adds the counters of a run's records, per table and in total, to the table ``load_audit``.

    ``outcomes`` has ``table_name``, ``source_path`` and ``outcome`` of every record read.
    """
    return store.append("load_audit", load_audit(outcomes).withColumn("run_time", run_stamp(run_ts)))


def staging_audit(store: TableStore) -> DataFrame:
    """Documents read, usable and failed per kind and in total."""
    return load_audit(staging_outcomes(store))


def staging_outcomes(store: TableStore) -> DataFrame:
    """``table_name, source_path, outcome`` of every staged document."""
    outcomes = [
        _staged(store, kind).select(
            F.lit(kind).alias("table_name"),
            "source_path",
            F.when(F.col("error").isNull(), "written").otherwise("failed").alias("outcome"),
        )
        for kind in STAGED
    ]
    return reduce(DataFrame.unionByName, outcomes)


def _collapsed(name: str, rows: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    table = TABLES[name]
    return collapse_batch(rows, table.keys, table.insert_only, order_cols, table.columns)


def _batch(store: TableStore, name: str, waves: Sequence[str], run_ts) -> DataFrame:
    return current_batch(slice_of(store.read(name, "node"), "CodOnda", waves), run_ts)


def load_file_records(store: TableStore, docs: DataFrame, run_ts, days_back: int = 3) -> Written:
    """Recent records of the last load go to the history, then the table is reloaded."""
    name, hist = "transformation_file_records", "transformation_file_records_hist"
    recent = history_window(store.read(name), run_ts, days_back=days_back)
    kept = store.upsert(hist, recent, ["updated_time"])
    rows = _collapsed(name, derive_file_records(docs), ["source_path", "_pos"])
    return {hist: kept, name: store.overwrite(name, rows)}


def load_connections(store: TableStore, docs: DataFrame, mask_password: bool = True) -> Written:
    rows = derive_connections(docs, mask_password)
    return {"connections": store.upsert("connections", rows, ["source_path", "_pos"])}


def load_content(store: TableStore, docs: DataFrame, run_ts) -> Written:
    return {"content": store.upsert("content", derive_content(docs, run_ts, "stored"), ["source_path"])}


def load_transformations(store: TableStore, waves: Sequence[str], run_ts) -> Written:
    """History snapshot of the waves, then their slices are replaced from ``content``."""
    old = slice_of(store.read("transformation", "node"), "CodOnda", waves)
    records = store.read("transformation_file_records")
    kept = store.append("transformation_hist", snapshot_history(old, records, rows_unique=True))
    rows = derive_transformations(_batch(store, "content", waves, run_ts), run_ts, "stored")
    order = ["content_name", "_content", "_pos"]
    return {
        "transformation_hist": kept,
        "transformation": store.replace_slices("transformation", rows, waves, order),
    }


def load_properties(store: TableStore, kind: str, waves: Sequence[str], run_ts) -> Written:
    """Session or advanced properties of the waves' current transformations."""
    name = f"transformation_{kind}_properties"
    rows = derive_properties(_batch(store, "transformation", waves, run_ts), kind, run_ts)
    return {name: store.replace_slices(name, rows, waves, ["content_name", "_pos"])}


def _has_adapter() -> Column:
    """Whether a transformation's adapter, or the first in an array of them, has an id."""
    # one of the two paths finds nothing; the adapters themselves are not read
    ids = [F.try_variant_get("data_adapter", path, "string") for path in ("$['$$ID']", "$[0]['$$ID']")]
    return F.coalesce(*ids).isNotNull()


def load_data_adapters(store: TableStore, waves: Sequence[str], run_ts) -> Written:
    """Naming anomalies are recorded once each, then the adapters are replaced.

    The run's counts of good and bad names and of adapters go to the table ``naming_summary``.
    """
    parents = _batch(store, "transformation", waves, run_ts)
    store.append("naming_summary", naming_summary(parents, _has_adapter()).withColumn("run_time", run_stamp(run_ts)))
    anomalies = store.insert_new(
        "AnomalyInsightTable", naming_anomalies(parents, run_ts), ["DateIns"]
    )
    name = "transformation_data_adapter"
    rows = derive_data_adapters(parents, run_ts, "stored")
    return {
        "AnomalyInsightTable": anomalies,
        name: store.replace_slices(name, rows, waves, ["content_name"]),
    }


def load_adapter_objects(store: TableStore, waves: Sequence[str], run_ts) -> Written:
    name = "transformation_data_adapter_object"
    parents = _batch(store, "transformation_data_adapter", waves, run_ts)
    rows = derive_adapter_objects(parents, run_ts)
    return {name: store.replace_slices(name, rows, waves, ["content_name"])}


def load_tasks(store: TableStore, docs: DataFrame, run_ts) -> Written:
    return {"s_task": store.upsert("s_task", derive_tasks(docs, run_ts, "stored"), ["source_path"])}


def load_task_children(store: TableStore, run_ts) -> Written:
    """Session properties and parameters of the tasks of the newest day, fully reloaded."""
    tasks = latest_batch(store.read("s_task", "node"), keys_unique=True)
    properties = derive_task_properties(tasks, run_ts)
    parameters = derive_task_parameters(tasks, run_ts)
    return {
        "s_task_sessionPropertiesList": store.overwrite("s_task_sessionPropertiesList", properties),
        "s_task_parameters": store.overwrite("s_task_parameters", parameters),
    }


def load_package_contents(store: TableStore, rows: DataFrame, run_ts) -> Written:
    store.overwrite("stage_packages", rows)
    staged_rows = store.read("stage_packages")
    good, _ = split_rejects(staged_rows)
    name = "ContentsofExportPackage"
    contents = derive_package_contents(good, run_ts)
    kept = F.coalesce(F.col("objectType").isin(PACKAGE_TYPES), F.lit(False))
    outcome = F.when(F.col("error").isNotNull(), "failed").when(~kept, "ignored").otherwise("written")
    keep_counters(store, staged_rows.select(F.lit(name).alias("table_name"), "source_path", outcome.alias("outcome")), run_ts)
    return {name: store.upsert(name, contents, ["source_path", "_pos"])}


def load_exported_objects(
    store: TableStore, docs: DataFrame, project: Column, projects: Sequence[str], run_ts
) -> Written:
    rows = derive_exported_objects(docs, project, run_ts)
    return {"exported_objects": store.replace_slices("exported_objects", rows, projects)}


def stage_taskflows(store: TableStore, items: DataFrame, more: bool = False) -> Written:
    """Keeps the items of task-flow files; with ``more``, what is staged already stays."""
    return {"stage_taskflows": _stage(store, "stage_taskflows", items, more)}


def load_taskflows(store: TableStore, items: DataFrame, waves: Sequence[str]) -> Written:
    """Entries of the waves are deleted from the ten tables, then the new items upserted."""
    stage_taskflows(store, items)
    return load_staged_taskflows(store, waves)


def load_staged_taskflows(store: TableStore, waves: Sequence[str]) -> Written:
    """The same with the items that are staged."""
    shredded = shred_taskflows(store.read("stage_taskflows"))
    of_waves = reduce(or_, [F.col("Name").like(f"____{wave}%") for wave in waves])
    doomed = doomed_keys(store.read("Item"), of_waves, "EntryId")
    doomed = stored(doomed, "doomed")  # the table it comes from is rewritten below

    def load(name: str) -> int:
        table, new = TABLES[name], shredded[name]

        def changed(old: DataFrame) -> DataFrame:
            kept = without_keys(old, doomed, "EntryId")
            if name == "Dependencies":
                return kept.unionByName(fresh_rows(kept, new, table.keys))
            return upsert_table(kept, new, table, TASKFLOW_ORDER)

        return store.rewrite(name, doomed.union(new.select("EntryId")), changed)

    # The tables do not depend on each other; writing some at a time keeps the cluster busy.
    # They change together or not at all.
    with store.publication(), ThreadPoolExecutor(max_workers=5) as pool:
        return dict(zip(TASKFLOW_TABLES, pool.map(load, TASKFLOW_TABLES)))


def load_standardization(store: TableStore, sheet: DataFrame, wave: str) -> Written:
    """The wave's sheet with clean and standard column names, fully reloaded."""
    name = f"padronizacao_migracao_{wave}"
    rows = nan_to_null(apply_rename_rules(clean_columns(sheet), wave))
    return {name: store.overwrite(name, rows)}
