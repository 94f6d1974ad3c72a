"""Queries that run whole load jobs into tables of the shared folder and read a table back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TABLES, TASKFLOW_TABLES
from ..sources.scratch import scratch_path
from ..sources.store import TableStore
from ..sources.taskflow_xml import parse_taskflows
from . import jobs
from .derived import (
    ORDER_WAVE,
    RUN_TS,
    TASK_NAME,
    WAVES,
    connection_documents,
    export_documents,
    file_record_documents,
    mapping_documents,
    package_rows,
    task_documents,
)
from .registry import CHECKS, query
from .source_queries import _taskflow_files
from .tables import table

_DAY_BEFORE = "2024-05-31 08:00:00"
_OF_WAVES = 'SELECT * FROM ({}) WHERE "CodOnda" IS NOT NULL'


def _store(spark) -> TableStore:
    return TableStore(spark, scratch_path(spark, "tables"))


def _with_content(spark, sf) -> TableStore:
    store = _store(spark)
    jobs.load_content(store, mapping_documents(spark, sf), RUN_TS)
    return store


def _with_transformations(spark, sf) -> TableStore:
    store = _with_content(spark, sf)
    jobs.load_transformations(store, WAVES, RUN_TS)
    return store


_CONTENT = CHECKS["content_docs"].replace(
    f"""TIMESTAMP '{RUN_TS}' AS "Dt_Inserted\"""", f"""TIMESTAMP '{_DAY_BEFORE}' AS "Dt_Inserted\""""
)


@query("job_content", _CONTENT)
def _(spark, sf):
    store = _store(spark)
    for run_ts in (_DAY_BEFORE, RUN_TS):
        jobs.load_content(store, mapping_documents(spark, sf), run_ts)
    return store.read("content").select(
        "id", "class", "CodOnda", "CodProcess", "annotations", "document_type", "name", "links",
        "variables", "Dt_Inserted", "Dt_updated",
    )


@query("job_transformations", _OF_WAVES.format(CHECKS["transformations"]))
def _(spark, sf):
    return _with_transformations(spark, sf).read("transformation").drop(
        "advanced_properties", "session_properties", "data_adapter"
    )


@query("job_properties", _OF_WAVES.format(CHECKS["advanced_properties"]))
def _(spark, sf):
    store = _with_transformations(spark, sf)
    jobs.load_properties(store, "advanced", WAVES, RUN_TS)
    return store.read("transformation_advanced_properties")


@query("job_session_properties", _OF_WAVES.format(CHECKS["session_properties"]))
def _(spark, sf):
    store = _with_transformations(spark, sf)
    jobs.load_properties(store, "session", WAVES, RUN_TS)
    return store.read("transformation_session_properties")


@query("job_naming", _OF_WAVES.format(CHECKS["naming_of_documents"]))
def _(spark, sf):
    store = _with_transformations(spark, sf)
    for _ in range(2):
        jobs.load_data_adapters(store, WAVES, RUN_TS)
    return store.read("AnomalyInsightTable")


@query("job_adapter_objects", _OF_WAVES.format(CHECKS["adapter_objects"]))
def _(spark, sf):
    store = _with_transformations(spark, sf)
    jobs.load_data_adapters(store, WAVES, RUN_TS)
    jobs.load_adapter_objects(store, WAVES, RUN_TS)
    return store.read("transformation_data_adapter_object").drop(
        "custom_query", "label", "object_type", "parent_path"
    )


@query(
    "job_file_records",
    f"""SELECT id, arg_min("CodOnda", path) AS "CodOnda", arg_min("CodProcess", path) AS "CodProcess",
        arg_max(name, path) AS name, arg_max(type, path) AS type, arg_max(size, path) AS size,
        arg_max(updated_time, path) AS updated_time,
        arg_max(updated_time_brazil, path) AS updated_time_brazil
      FROM (SELECT *, concat('records/', "CodProcess") AS path FROM ({CHECKS["file_records"]}))
      GROUP BY id
      HAVING arg_max(updated_time_brazil, path) >= TIMESTAMP '2024-01-22 00:00:00'""",
)
def _(spark, sf):
    store = _store(spark)
    for _ in range(2):
        jobs.load_file_records(store, file_record_documents(spark, sf), "2024-01-25 02:00:00")
    return store.read("transformation_file_records_hist")


# Records of equal ids are one, the last document winning.
_RELOADED = f"""SELECT id, arg_max(name, path) AS name, arg_max(type, path) AS type, arg_max(size, path) AS size,
        arg_max(updated_time, path) AS updated_time, arg_max(updated_time_brazil, path) AS updated_time_brazil,
        arg_min("CodOnda", path) AS "CodOnda", arg_min("CodProcess", path) AS "CodProcess"
      FROM (SELECT *, concat('records/', "CodProcess") AS path FROM ({CHECKS["file_records"]})) GROUP BY id"""


@query("job_file_records_table", _RELOADED)
def _(spark, sf):
    """The reloaded table itself, after two loads."""
    store = _store(spark)
    for _ in range(2):
        jobs.load_file_records(store, file_record_documents(spark, sf), "2024-01-25 02:00:00")
    return store.read("transformation_file_records")


# The newest day of the records, and what was loaded for their keys before.
_RECORDS = """SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'IMAGE' ELSE 'BIN' END AS type,
    TIMESTAMP '2024-05-30 00:00:00' + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS updated FROM orders"""


@query(
    "job_transformation_history",
    f"""SELECT id, name, content_name, "CodOnda", "CodProcess" FROM ({_OF_WAVES.format(CHECKS["transformations"])}) t
      WHERE EXISTS (SELECT 1 FROM ({_RECORDS}) r WHERE r.type <> 'IMAGE'
          AND CAST(updated AS DATE) = (SELECT max(CAST(updated AS DATE)) FROM ({_RECORDS}))
          AND t."CodOnda" = {ORDER_WAVE.replace("o_custkey", "r.o_custkey")}
          AND t."CodProcess" = CAST(r.o_custkey % 100 AS VARCHAR))""",
)
def _(spark, sf):
    """A second load keeps the first one's rows of the waves and processes with records of the newest day."""
    store = _with_transformations(spark, sf)
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.lit("f").alias("name"),
        F.expr("IF(o_orderkey % 4 = 0, 'IMAGE', 'BIN')").alias("type"),
        F.lit(0).alias("size"),
        F.expr("TIMESTAMP_NTZ'2024-05-30 00:00:00' + make_interval(0, 0, 0, int(o_orderkey % 3))").alias("updated_time"),
        F.expr(ORDER_WAVE).alias("CodOnda"),
        F.expr("string(o_custkey % 100)").alias("CodProcess"),
    )
    store.overwrite("transformation_file_records", records.withColumn("updated_time_brazil", F.col("updated_time")))
    jobs.load_transformations(store, WAVES, RUN_TS)
    return store.read("transformation_hist").select("id", "name", "content_name", "CodOnda", "CodProcess")


@query("job_connections", CHECKS["connections"])
def _(spark, sf):
    store = _store(spark)
    jobs.load_connections(store, connection_documents(spark, sf))
    return store.read("connections").select(
        "id", "name", "description", "port", "type", "password", "schema_name", "host",
        "majorUpdateTime", "majorUpdateTime_brazil", "connParams", "federatedId", "internal",
        "vaultEnabled",
    )


# Task names repeat where the source repeats a line, and the last document wins.
_UNIQUE_TASKS = CHECKS["tasks"].replace("SELECT ", "SELECT DISTINCT ", 1)


@query("job_tasks", _UNIQUE_TASKS)
def _(spark, sf):
    store = _store(spark)
    jobs.load_tasks(store, task_documents(spark, sf), RUN_TS)
    jobs.load_task_children(store, RUN_TS)
    tasks = store.read("s_task").select("name", "CodOnda", "CodProcess", "Dt_Inserted", "Dt_Updated")
    children = store.read("s_task_sessionPropertiesList").select("task_name").distinct()
    return tasks.join(children, F.col("name") == F.col("task_name"), "left_semi")


def _task_children(spark, sf) -> TableStore:
    """Tasks whose documents are told apart by their paths where the source repeats a line's number."""
    docs = task_documents(spark, sf, keep=["l_partkey", "l_quantity", "l_returnflag", "l_linestatus"])
    place = "concat(source_path, '_', lpad(string(l_partkey), 12, '0'), lpad(string(int(l_quantity)), 6, '0'), l_returnflag, l_linestatus)"
    store = _store(spark)
    jobs.load_tasks(store, docs.withColumn("source_path", F.expr(place)), RUN_TS)
    jobs.load_task_children(store, RUN_TS)
    return store


# A task is known by its name, and the last document of a name is the task.
_LAST_LINE = f"""(SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY {TASK_NAME}
    ORDER BY l_partkey DESC, CAST(l_quantity AS INTEGER) DESC, l_returnflag DESC, l_linestatus DESC) = 1)"""


@query("job_task_parameters", CHECKS["task_parameters"].replace("FROM lineitem", f"FROM {_LAST_LINE}"))
def _(spark, sf):
    return _task_children(spark, sf).read("s_task_parameters")


@query("job_task_properties", CHECKS["task_properties_run"].replace("FROM lineitem", f"FROM {_LAST_LINE}"))
def _(spark, sf):
    return _task_children(spark, sf).read("s_task_sessionPropertiesList")


@query("job_package_contents", CHECKS["package_contents"])
def _(spark, sf):
    store = _store(spark)
    rows = package_rows(spark, sf).select(
        F.concat(F.lit("lists/"), "id").alias("source_path"),
        F.lit(0).cast("long").alias("_pos"),
        "*",
        F.lit(None).cast("string").alias("error"),
    )
    jobs.load_package_contents(store, rows, RUN_TS)
    return store.read("ContentsofExportPackage")


@query(
    "job_package_counters",
    f"""SELECT table_name, count(*) AS sources, count(*) AS records_read,
        count(*) FILTER (p_partkey % 4 < 3) AS written, count(*) FILTER (p_partkey % 4 = 3) AS ignored,
        CAST(0 AS BIGINT) AS failed, true AS success, TIMESTAMP '{RUN_TS}' AS run_time
      FROM part, (SELECT unnest(['ContentsofExportPackage', NULL]) AS table_name) GROUP BY table_name""",
)
def _(spark, sf):
    """What a load of package lists has counted, per table and in total."""
    store = _store(spark)
    rows = package_rows(spark, sf).select(
        F.concat(F.lit("lists/"), "id").alias("source_path"),
        F.lit(0).cast("long").alias("_pos"),
        "*",
        F.lit(None).cast("string").alias("error"),
    )
    jobs.load_package_contents(store, rows, RUN_TS)
    return store.read("load_audit")


@query("job_naming_summary", _OF_WAVES.format(CHECKS["naming_summary"]))
def _(spark, sf):
    """The names and adapters that an adapter load has counted."""
    store = _with_transformations(spark, sf)
    jobs.load_data_adapters(store, WAVES, RUN_TS)
    return store.read("naming_summary").drop("run_time")


@query("job_exported_objects", CHECKS["exported_objects"])
def _(spark, sf):
    store = _store(spark)
    docs = export_documents(spark, sf)
    for _ in range(2):
        jobs.load_exported_objects(store, docs, F.col("project"), WAVES, RUN_TS)
    info = F.get_json_object("additional_info_json", "$.contentType")
    return (
        store.read("exported_objects")
        .withColumn("info_content_type", info)
        .drop("path", "additional_info_json")
    )


def _with_taskflows(spark, sf) -> TableStore:
    store = _store(spark)
    for _ in range(2):
        jobs.load_taskflows(store, parse_taskflows(_taskflow_files(spark, sf)), WAVES)
    return store


@query("job_taskflows", f"SELECT DISTINCT * FROM ({CHECKS['taskflow_dependencies']})")
def _(spark, sf):
    return _with_taskflows(spark, sf).read("Dependencies")


@query("job_taskflows_item", CHECKS["taskflow_item"])
def _(spark, sf):
    return _with_taskflows(spark, sf).read("Item")


# The tables whose columns are texts and flags, each row as one text.
_PLAIN = [name for name in TASKFLOW_TABLES if name not in ("Item", "Dependencies")]


def _row_sql(name: str) -> str:
    columns = ", ".join(f'CAST("{c}" AS VARCHAR)' for c in TABLES[name].columns)
    check = CHECKS[f"taskflow_{name.lower()}"]
    return f"SELECT '{name}' AS table_name, concat_ws('|', {columns}) AS row_text FROM ({check})"


@query("job_taskflows_tables", " UNION ALL ".join(map(_row_sql, _PLAIN)))
def _(spark, sf):
    store = _with_taskflows(spark, sf)
    rows = [
        store.read(name).select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in TABLES[name].columns]).alias("row_text"),
        )
        for name in _PLAIN
    ]
    return reduce(DataFrame.unionAll, rows)


@query("job_standardization", CHECKS["rename_rules"])
def _(spark, sf):
    store = _store(spark)
    sheet = table(spark, sf, "supplier").toDF("UME TRAFEGO", "(TCOGER)", "s_nationkey", "s_acctbal")
    jobs.load_standardization(store, sheet, "684")
    return store.read("padronizacao_migracao_684")
