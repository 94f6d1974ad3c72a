"""Queries that un-nest asset documents built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import elements_of
from ..operators.assets import (
    derive_connections,
    derive_exported_objects,
    derive_file_records,
    derive_package_contents,
    document_records,
)
from ..operators.lineage import lineage
from ..operators.mappings import (
    derive_adapter_objects,
    derive_content,
    derive_data_adapters,
    derive_properties,
    derive_transformations,
)
from ..operators.quality import load_audit, naming_anomalies, naming_summary, split_rejects
from ..operators.tasks import derive_task_parameters, derive_task_properties, derive_tasks
from ..schemas import PARAMETER_FLAGS, PARAMETER_LISTS, PARAMETER_OBJECTS
from ..sources.documents import flag_bad_json, json_error
from ..sources.scratch import stored
from .derived import (
    CONTENT_NAME,
    ORDER_WAVE,
    RUN_TS,
    TASK_NAME,
    connection_documents,
    export_documents,
    file_record_documents,
    mapping_documents,
    package_rows,
    task_documents,
    wave_sql,
)
from .registry import query

_RUN = f"TIMESTAMP '{RUN_TS}'"
_NOTE = (
    "concat('As 3 primeiras posições de ', name, ' devem seguir os prefixos válidos: agg_, exp_, "
    "fil_, jnr_, rtr_, seq_, str_, trc_, uni_, srt_, nor_, tgt_, src_, lkp_. Nomes ignorados: "
    "BI_CTRL_TRANSFORMACAO e prefixo ''ff_''')"
)

# The relational view of the mapping documents: doc, tr (transformations), ad (adapters).
_DOC = f"""doc AS (SELECT *, {CONTENT_NAME} AS content_name,
    CASE WHEN o_orderkey % 41 > 1 THEN {ORDER_WAVE} END AS "CodOnda",
    CASE WHEN o_orderkey % 41 > 1 THEN CAST(o_custkey % 100 AS VARCHAR) END AS "CodProcess",
    o_orderdate + to_seconds(o_orderkey % 86400) AS moment
  FROM orders WHERE o_orderkey % 97 NOT IN (5, 6, 7) AND o_orderkey % 53 > 1)"""
_TR = f"""{_DOC}, tr AS (SELECT *, create_time - INTERVAL 3 HOUR AS create_time_brazil FROM (
    SELECT *, o_orderkey + t AS k,
      CASE WHEN (o_orderkey + t) % 31 = 3 THEN CAST(o_orderkey * 10 + t AS VARCHAR)
        ELSE concat('T', o_orderkey, '_', t) END AS id,
      CASE (o_orderkey + t) % 7 WHEN 0 THEN concat('src_', o_orderkey)
        WHEN 1 THEN concat('TGT_', o_orderkey) WHEN 2 THEN concat('Ff_', o_orderkey)
        WHEN 3 THEN 'BI_CTRL_TRANSFORMACAO' WHEN 4 THEN concat('bad_', o_orderkey)
        WHEN 5 THEN '' ELSE 'bi_ctrl_transformacao' END AS name,
      CASE (o_orderkey + t) % 6 WHEN 0 THEN moment WHEN 3 THEN moment
        WHEN 4 THEN moment - INTERVAL 2 HOUR
        ELSE TIMESTAMP '1990-01-01 00:00:00' END AS create_time
    FROM doc, (SELECT unnest([0, 1, 2]) AS t)
    WHERE (t = 0 OR o_orderkey % 10 <> 3) AND (o_orderkey + t) % 31 > 2))"""
_AD = f"""{_TR}, ad AS (SELECT *, concat('A', o_orderkey, '_', t) AS adapter_id,
    concat('O', o_orderkey, '_', t) AS object_id FROM tr WHERE k % 5 < 2)"""


def _content(spark, sf, nested="node"):
    return derive_content(mapping_documents(spark, sf), RUN_TS, nested)


def _transformations(spark, sf, nested="node"):
    return derive_transformations(_content(spark, sf), RUN_TS, nested)


@query(
    "content_docs",
    f"""WITH {_DOC} SELECT concat('M', o_orderkey) AS id, o_orderstatus AS class, "CodOnda",
      "CodProcess", CASE o_orderkey % 4 WHEN 0 THEN '{{}}' WHEN 1 THEN 'null'
        ELSE concat('{{"a":[1,2],"z":', o_custkey, '}}') END AS annotations,
      CASE WHEN o_orderkey % 3 = 2 THEN 'MAP' END AS document_type, content_name AS name,
      '[]' AS links, '{{}}' AS variables, {_RUN} AS "Dt_Inserted", {_RUN} AS "Dt_updated"
      FROM doc""",
)
def _(spark, sf):
    return _content(spark, sf, "text").select(
        "id", "class", "CodOnda", "CodProcess", "annotations", "document_type", "name", "links",
        "variables", "Dt_Inserted", "Dt_updated",
    )


@query(
    "transformations",
    f"""WITH {_TR} SELECT id, o_orderpriority AS class, '{{}}' AS annotations, create_time,
      create_time_brazil, name, CASE k % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'x'
        WHEN 2 THEN '{{"a":1}}' WHEN 3 THEN 'None' ELSE '' END AS "inputSorted",
      concat('[{{"g":', o_custkey, '}}]') AS _groups, k % 3 = 0 AS generate_filename_port,
      FALSE AS use_labels, FALSE AS use_sequence_fields, '[]' AS fields, content_name,
      "CodOnda", "CodProcess", {_RUN} AS "Dt_Inserted", {_RUN} AS "Dt_updated" FROM tr""",
)
def _(spark, sf):
    return _transformations(spark, sf, "text").drop(
        "advanced_properties", "session_properties", "data_adapter", "_content", "_pos"
    )


def _property_sql(kind: str, true: str, false: str, id_column: str, name: str) -> str:
    value = f"""CASE (k + i) % 9 WHEN 0 THEN '{true}' WHEN 1 THEN '{false}' WHEN 2 THEN ''
        WHEN 3 THEN CAST(o_custkey AS VARCHAR) WHEN 4 THEN '2.5'
        WHEN 5 THEN '{{"a":"x","b":[1,2]}}' WHEN 6 THEN '[1,"z"]' WHEN 7 THEN ''
        ELSE o_orderpriority END"""
    return f"""WITH {_TR} SELECT concat('{kind}', o_orderkey, '_', t, '_', i) AS "{id_column}",
      id AS id_transf, concat('c', i) AS class, {name} AS name, {value} AS value, content_name,
      "CodOnda", "CodProcess", create_time_brazil AS "Dt_Inserted", {_RUN} AS "Dt_updated"
      FROM tr, (SELECT unnest([0, 1]) AS i)
      WHERE k % 4 < 3 AND (i = 0 OR k % 4 <> 1) AND (k + i) % 13 > 1"""


_P_NAME = "CASE WHEN (o_orderkey + i) % 5 > 1 THEN concat('p', o_custkey % 10) ELSE {} END"


@query("session_properties", _property_sql("S", "True", "False", "id", _P_NAME.format("''")))
def _(spark, sf):
    return derive_properties(_transformations(spark, sf), "session", RUN_TS).drop("_pos")


@query(
    "advanced_properties",
    _property_sql(
        "D", "true", "false", "Id", _P_NAME.format("concat('property_D', o_orderkey, '_', t, '_', i)")
    ),
)
def _(spark, sf):
    return derive_properties(_transformations(spark, sf), "advanced", RUN_TS).drop("_pos")


@query(
    "properties_of_stored_text",
    _property_sql("S", "True", "False", "id", _P_NAME.format("''")),
)
def _(spark, sf):
    content = derive_content(mapping_documents(spark, sf), RUN_TS)
    return derive_properties(derive_transformations(content, RUN_TS), "session", RUN_TS).drop("_pos")


@query(
    "data_adapters",
    f"""WITH {_AD} SELECT adapter_id AS id, id AS id_transf, 'ad' AS _class,
      concat('C', o_custkey % 50) AS connection_id, o_orderstatus AS object_type,
      CAST(NULL AS VARCHAR) AS type_system, '{{}}' AS runtime_attributes,
      concat('{{"r":', o_custkey, '}}') AS read_options, content_name, "CodOnda", "CodProcess",
      create_time_brazil AS "Dt_Inserted", {_RUN} AS "Dt_updated" FROM ad""",
)
def _(spark, sf):
    return derive_data_adapters(_transformations(spark, sf), RUN_TS).select(
        "id", "id_transf", "_class", "connection_id", "object_type", "type_system",
        "runtime_attributes", "read_options", "content_name", "CodOnda", "CodProcess",
        "Dt_Inserted", "Dt_updated",
    )


@query(
    "adapter_objects",
    f"""WITH {_AD} SELECT object_id AS id, id AS id_transf, adapter_id AS id_data_adapter,
      "CodOnda", "CodProcess", CASE o_custkey % 5 WHEN 0 THEN 12 WHEN 1 THEN 7 WHEN 4 THEN NULL
        ELSE 0 END AS class, '' AS name, o_orderstatus AS object_name,
      concat('/p/', o_custkey) AS path,
      CASE WHEN o_custkey % 6 IN (0, 1, 3) THEN 'true' ELSE 'false' END AS retain_metadata,
      CASE o_custkey % 4 WHEN 0 THEN '[{{"n":1}}]' WHEN 1 THEN ' [9] ' WHEN 2 THEN '"plain"'
        ELSE '[]' END AS fields, '{{}}' AS file_attrs, content_name,
      create_time_brazil AS "Dt_Inserted", {_RUN} AS "Dt_updated"
      FROM ad WHERE o_orderkey % 3 < 2 AND k % 17 > 1""",
)
def _(spark, sf):
    adapters = derive_data_adapters(_transformations(spark, sf), RUN_TS, "node")
    return derive_adapter_objects(adapters, RUN_TS).drop(
        "custom_query", "label", "object_type", "parent_path"
    )


@query(
    "naming_of_documents",
    f"""WITH {_TR} SELECT "CodOnda", 5000 AS "InconsistencyCode", {_NOTE} AS "Note",
      content_name AS "ProcessName", 'Map' AS "ObjectType", "CodProcess", {_RUN} AS "DateIns"
      FROM tr WHERE k % 7 IN (4, 6)""",
)
def _(spark, sf):
    return naming_anomalies(_transformations(spark, sf), RUN_TS)


@query(
    "naming_summary",
    f"""WITH {_TR} SELECT "CodOnda", count(*) AS total,
      count(*) FILTER (k % 7 NOT IN (4, 6)) AS valid_names,
      count(*) FILTER (k % 7 IN (4, 6)) AS invalid_names,
      count(*) FILTER (k % 5 < 2) AS adapters FROM tr GROUP BY 1""",
)
def _(spark, sf):
    rows = _transformations(spark, sf)
    has_adapter = F.coalesce(
        F.try_variant_get(F.get(elements_of(F.col("data_adapter")), F.lit(0)), "$['$$ID']", "string")
        .isNotNull(),
        F.lit(False),
    )
    return naming_summary(rows, has_adapter)


@query(
    "rejected_documents",
    """SELECT concat('maps/', o_orderkey, '.json') AS source_path,
      'not a JSON document' AS error FROM orders WHERE o_orderkey % 97 = 5""",
)
def _(spark, sf):
    _, rejects = split_rejects(flag_bad_json(mapping_documents(spark, sf)))
    return rejects.select("source_path", "error")


@query(
    "load_audit",
    f"""SELECT wave AS table_name, count(DISTINCT source) AS sources, count(*) AS records_read,
      CAST(sum(written) AS BIGINT) AS written, CAST(sum(ignored) AS BIGINT) AS ignored,
      CAST(sum(failed) AS BIGINT) AS failed,
      sum(failed) = 0 AND sum(written) > 0 AS success
      FROM (SELECT o_orderstatus AS wave, o_orderkey AS source,
        CASE WHEN o_orderkey % 97 = 5 THEN 1 ELSE 0 END AS failed,
        CASE WHEN o_orderkey % 97 IN (6, 7) OR (o_orderkey % 97 <> 5 AND o_orderkey % 53 < 2)
          THEN 1 ELSE 0 END AS ignored,
        CASE WHEN o_orderkey % 97 NOT IN (5, 6, 7) AND o_orderkey % 53 > 1
          THEN 1 ELSE 0 END AS written FROM orders)
      GROUP BY ROLLUP (wave)""",
)
def _(spark, sf):
    docs = mapping_documents(spark, sf, keep=["o_orderstatus"])
    node, failed = F.try_parse_json("body"), json_error(F.col("body")).isNotNull()
    iid = F.try_variant_get(F.col("v"), "$.content['$$IID']", "string")
    outcomes = docs.select("o_orderstatus", "source_path", node.alias("v"), failed.alias("f")).select(
        F.col("o_orderstatus").alias("table_name"),
        "source_path",
        F.when(F.col("f"), "failed")
        .when(F.coalesce(iid, F.lit("")) == "", "ignored")
        .otherwise("written")
        .alias("outcome"),
    )
    return load_audit(outcomes)


@query(
    "lineage",
    f"""WITH {_AD}, good AS (SELECT * FROM ad WHERE o_orderkey % 3 < 2 AND k % 17 > 1),
      names AS (SELECT {CONTENT_NAME} AS content_name, max(concat('M', o_orderkey)) AS content_id
        FROM orders WHERE o_orderkey % 97 NOT IN (5, 6, 7) AND o_orderkey % 53 > 1 GROUP BY 1)
      SELECT object_id, o_orderstatus AS object_name, concat('/p/', o_custkey) AS object_path,
        adapter_id AS id_data_adapter, o_orderstatus AS adapter_type, id AS id_transf,
        name AS transformation_name, content_id, content_name,
        concat('C', o_custkey % 50) AS connection_id, c_name AS connection_name,
        c_mktsegment AS connection_type, "CodOnda", "CodProcess"
      FROM good LEFT JOIN names USING (content_name)
      LEFT JOIN customer ON c_custkey = o_custkey % 50 AND c_custkey % 10 < 8""",
)
def _(spark, sf):
    # parsed once for its own rows and for what is un-nested from it
    content = _content(spark, sf).select("id", "name", "CodOnda", "CodProcess", "transformations")
    content = stored(content, "content")
    transformations = stored(
        derive_transformations(content, RUN_TS, "node").select(
            "id", "name", "content_name", "CodOnda", "CodProcess", "create_time_brazil",
            "data_adapter",
        ),
        "transformation",
    )
    adapters = derive_data_adapters(transformations, RUN_TS, "node")
    return lineage(
        derive_adapter_objects(adapters, RUN_TS),
        adapters,
        transformations,
        content,
        derive_connections(connection_documents(spark, sf)),
    )


_FLAG = "CASE WHEN (l_orderkey + l_linenumber) % 7 IN (0, 1, 2, 6) THEN 1 ELSE 0 END"
_TASK_CODES = f"""{wave_sql("l_suppkey")} AS "CodOnda",
    CAST(l_suppkey % 100 AS VARCHAR) AS "CodProcess" """


@query(
    "tasks",
    f"""SELECT {TASK_NAME} AS name, {_TASK_CODES}, {_RUN} AS "Dt_Inserted",
      {_RUN} AS "Dt_Updated" FROM lineitem""",
)
def _(spark, sf):
    return derive_tasks(task_documents(spark, sf), RUN_TS).select(
        "name", "CodOnda", "CodProcess", "Dt_Inserted", "Dt_Updated"
    )


def _parameter_sql() -> str:
    given = {
        "newObject": _FLAG,
        "isFileList": "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END",
        "runtimeAttrs": """CASE l_linenumber % 4 WHEN 0 THEN 'null'
            WHEN 1 THEN concat('{"q":', CAST(l_quantity AS INTEGER), '}') ELSE '{}' END""",
        "overriddenFields": """concat('["', l_linestatus, '"]')""",
    }
    columns = {k: "0" for k in PARAMETER_FLAGS}
    columns |= {k: "'{}'" for k in PARAMETER_OBJECTS} | {k: "'[]'" for k in PARAMETER_LISTS}
    columns |= given
    listed = ", ".join(f'{sql} AS "{k}"' for k, sql in columns.items())
    return f"""SELECT {_TASK_CODES}, {TASK_NAME} AS task_name, concat('P', l_partkey) AS id,
      l_returnflag AS name, '' AS type, CASE l_linenumber % 3 WHEN 0 THEN '' ELSE NULL END AS label,
      '' AS "sourceConnectionId", {listed}, {_RUN} AS "Dt_Inserted", {_RUN} AS "Dt_updated"
      FROM lineitem, (SELECT unnest([0, 1]) AS i)
      WHERE l_linenumber % 3 < 2 AND (i = 0 OR l_linenumber % 3 = 1)"""


@query("task_parameters", _parameter_sql())
def _(spark, sf):
    return derive_task_parameters(derive_tasks(task_documents(spark, sf), RUN_TS, "node"), RUN_TS)


def _task_property_sql(inserted: str) -> str:
    return f"""SELECT {_TASK_CODES}, {TASK_NAME} AS task_name, l_returnflag AS name,
      CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS value, {_FLAG} AS recommended,
      {inserted} AS "Dt_Inserted", {_RUN} AS "Dt_Updated" FROM lineitem"""


@query("task_properties", _task_property_sql("TIMESTAMP '2024-05-01 00:00:00'"))
def _(spark, sf):
    tasks = derive_tasks(task_documents(spark, sf), "2024-05-01 00:00:00", "node")
    return derive_task_properties(tasks, RUN_TS)


@query("task_properties_run", _task_property_sql(_RUN))
def _(spark, sf):
    tasks = derive_tasks(task_documents(spark, sf), "2024-05-01 00:00:00")
    return derive_task_properties(tasks, RUN_TS, inserted_from="run")


@query(
    "json_roots",
    """SELECT concat('records/', event_id) AS source_path,
      CASE event_id % 5 WHEN 0 THEN 2 ELSE 1 END AS records FROM events WHERE event_id % 5 <> 4""",
)
def _(spark, sf):
    records = document_records(file_record_documents(spark, sf), "records", "fileRecord")
    return records.groupBy("source_path").agg(F.count("*").alias("records"))


@query(
    "file_records",
    """SELECT id, concat('f', user_id, '_x', event_id, '.bin') AS name, type, size,
        utc AS updated_time, utc - INTERVAL 3 HOUR AS updated_time_brazil,
        CAST(user_id AS VARCHAR) AS "CodOnda", CAST(event_id AS VARCHAR) AS "CodProcess"
      FROM (SELECT *, CASE WHEN event_id % 7 = 6 THEN 0 ELSE event_id END AS id,
          CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS type,
          CASE WHEN event_id % 4 = 0 THEN 0 ELSE user_id END AS size,
          CASE WHEN event_id % 11 = 0 THEN TIMESTAMP '1970-01-01 00:00:00'
            ELSE date_trunc('millisecond', ts) END AS utc
        FROM events)
      WHERE event_id % 5 <> 4 AND event_id % 7 NOT IN (2, 3) AND event_id % 11 NOT IN (1, 2)
        AND event_id % 13 <> 0""",
)
def _(spark, sf):
    return derive_file_records(file_record_documents(spark, sf)).drop("source_path", "_pos")


@query(
    "connections",
    """SELECT concat('C', c_custkey) AS id, c_name AS name,
        CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE c_mktsegment END AS description,
        CAST(1000 + c_nationkey AS VARCHAR) AS port, c_mktsegment AS type, '***' AS password,
        CAST(NULL AS VARCHAR) AS schema_name, CAST(c_nationkey AS VARCHAR) AS host,
        changed AS "majorUpdateTime", changed - INTERVAL 3 HOUR AS "majorUpdateTime_brazil",
        CASE WHEN c_custkey % 4 = 2 THEN concat('{"a":"', c_mktsegment, '"}') END AS "connParams",
        CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
          ELSE concat('saas:@f', c_custkey) END AS "federatedId",
        CASE c_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN NULL ELSE FALSE END
          AS internal, FALSE AS "vaultEnabled"
      FROM (SELECT *, CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL
          ELSE TIMESTAMP '2024-01-01 00:00:00' + to_hours(c_custkey) END AS changed FROM customer)
      WHERE c_custkey % 10 < 8""",
)
def _(spark, sf):
    return derive_connections(connection_documents(spark, sf)).select(
        "id", "name", "description", "port", "type", "password", "schema_name", "host",
        "majorUpdateTime", "majorUpdateTime_brazil", "connParams", "federatedId", "internal",
        "vaultEnabled",
    )


_EXPORT_WAVE = wave_sql("doc_id")


@query(
    "exported_objects",
    f"""SELECT concat('g', doc_id, '_', i) AS object_guid,
        CASE i WHEN 0 THEN concat('o_', {_EXPORT_WAVE}, '_', doc_id)
          WHEN 1 THEN concat('plain ', lang) END AS object_name, source AS object_type,
        CASE i WHEN 0 THEN text END AS description, CASE i WHEN 0 THEN lang END AS content_type,
        CAST(NULL AS VARCHAR) AS document_state,
        CASE i WHEN 0 THEN lang END AS info_content_type,
        {_EXPORT_WAVE} AS cod_projeto, CASE i WHEN 0 THEN CAST(doc_id AS VARCHAR) END AS cod_processo,
        {_RUN} AS created_at
      FROM documents, (SELECT unnest([0, 1]) AS i)""",
)
def _(spark, sf):
    docs = export_documents(spark, sf)
    rows = derive_exported_objects(docs, F.col("project"), RUN_TS)
    info = F.get_json_object("additional_info_json", "$.contentType")
    return rows.withColumn("info_content_type", info).drop("path", "additional_info_json")


_PACKAGE_TYPE = "(CASE p_partkey % 4 WHEN 0 THEN 'MTT' WHEN 1 THEN 'TASKFLOW' WHEN 2 THEN 'DTEMPLATE' END)"


@query(
    "package_contents",
    f"""SELECT concat('id', p_partkey) AS id,
        CASE WHEN p_partkey % 7 < 5 THEN CAST({wave_sql("p_partkey")} AS INTEGER) ELSE 0 END
          AS "CodOnda", CASE WHEN p_partkey % 7 < 5 THEN p_size ELSE 0 END AS "CodProcess",
        concat('/Explore/', p_name) AS "objectPath",
        concat(CASE WHEN p_partkey % 4 = 1 THEN 'tf_' ELSE 'm_a_b_' END, {wave_sql("p_partkey")},
          '_', p_size) AS "objectName", {_PACKAGE_TYPE} AS "objectType",
        {_RUN} AS "Dt_Inserted", {_RUN} AS "Dt_updated"
      FROM part WHERE p_partkey % 4 < 3""",
)
def _(spark, sf):
    return derive_package_contents(package_rows(spark, sf), RUN_TS)
