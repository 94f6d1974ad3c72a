"""Queries on whole tables: upserts, slices, deletes, history, project folders, sheets rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.history import (
    current_batch,
    history_window,
    latest_batch,
    slice_of,
    snapshot_history,
)
from ..operators.merge import (
    cascade_delete,
    collapse_batch,
    insert_ignore,
    latest_per_key,
    replace_slice,
    upsert,
)
from ..operators.quality import naming_anomalies
from ..operators.standardize import apply_rename_rules, clean_columns, nan_to_null
from ..sources.paths import project_folders, project_label
from .document_queries import _NOTE, _RUN
from .derived import RUN_TS
from .registry import query
from .tables import table

_CUT = "2024-01-16 00:00:00"
_LATEST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS rn FROM events{}) WHERE rn = 1)"""


def _events(spark, sf):
    return table(spark, sf, "events")


def _split_events(spark, sf):
    """Events before and from the cut, as target and updates."""
    cut = F.lit(_CUT).cast("timestamp_ntz")
    rows = _events(spark, sf).select(
        "user_id",
        F.col("event_id").alias("first_event"),
        F.col("event_id").alias("last_event"),
        "event_type",
        "value",
        "ts",
    )
    return rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut)


@query(
    "latest_per_key",
    f"SELECT user_id, event_id, event_type, ts FROM {_LATEST.format('')}",
)
def _(spark, sf):
    rows = _events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    return latest_per_key(rows, ["user_id"], ["ts", "event_id"])


@query(
    "collapse_batch",
    """SELECT user_id, event_type, min(event_id) AS first_event, max(event_id) AS last_event,
      arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type""",
)
def _(spark, sf):
    rows = _events(spark, sf).withColumns(
        {"first_event": F.col("event_id"), "last_event": F.col("event_id")}
    )
    return collapse_batch(
        rows,
        ["user_id", "event_type"],
        ["first_event"],
        ["event_id"],
        ["user_id", "event_type", "first_event", "last_event", "value"],
    )


@query(
    "upsert_events",
    f"""WITH old AS (SELECT user_id, event_id AS first_event, event_id AS last_event, event_type,
        value FROM {_LATEST.format(f" WHERE ts < TIMESTAMP '{_CUT}'")}),
      new AS (SELECT user_id, event_id AS last_event, event_type, value
        FROM {_LATEST.format(f" WHERE ts >= TIMESTAMP '{_CUT}'")}),
      first AS (SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event FROM events
        WHERE ts >= TIMESTAMP '{_CUT}' GROUP BY user_id)
      SELECT coalesce(old.user_id, new.user_id) AS user_id,
        CASE WHEN old.user_id IS NULL THEN first.first_event ELSE old.first_event END AS first_event,
        CASE WHEN new.user_id IS NULL THEN old.last_event ELSE new.last_event END AS last_event,
        CASE WHEN new.user_id IS NULL THEN old.event_type ELSE new.event_type END AS event_type,
        CASE WHEN new.user_id IS NULL THEN old.value ELSE new.value END AS value
      FROM old FULL JOIN new ON old.user_id = new.user_id
        LEFT JOIN first ON first.user_id = new.user_id""",
)
def _(spark, sf):
    before, after = _split_events(spark, sf)
    columns = ["user_id", "first_event", "last_event", "event_type", "value"]
    target = latest_per_key(before, ["user_id"], ["ts", "last_event"]).select(*columns)
    return upsert(target, after, ["user_id"], ["ts", "last_event"], ["first_event"])


@query(
    "insert_ignore",
    f"""WITH old AS (SELECT user_id, event_type, min(event_id) AS event_id FROM events
        WHERE ts < TIMESTAMP '{_CUT}' GROUP BY ALL),
      new AS (SELECT user_id, event_type, min(event_id) AS event_id FROM events
        WHERE ts >= TIMESTAMP '{_CUT}' GROUP BY ALL)
      SELECT * FROM old UNION ALL SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old
        WHERE old.user_id = new.user_id AND old.event_type = new.event_type)""",
)
def _(spark, sf):
    cut = F.lit(_CUT).cast("timestamp_ntz")
    rows = _events(spark, sf)
    target = (
        rows.filter(F.col("ts") < cut)
        .groupBy("user_id", "event_type")
        .agg(F.min("event_id").alias("event_id"))
    )
    return insert_ignore(
        target, rows.filter(F.col("ts") >= cut), ["user_id", "event_type"], ["event_id"]
    )


@query(
    "insert_ignore_whole_row",
    "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem",
)
def _(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    target = pairs.filter("l_returnflag = 'R'").select("l_orderkey", "l_partkey").distinct()
    return insert_ignore(target, pairs.drop("l_returnflag"), ["l_orderkey", "l_partkey"])


@query(
    "replace_slice",
    """SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderstatus <> 'O'
      UNION ALL SELECT o_orderkey, 'O', o_custkey FROM orders WHERE o_orderstatus = 'P'""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    new = slice_of(orders, "o_orderstatus", ["P"]).withColumn("o_orderstatus", F.lit("O"))
    return replace_slice(orders, new, "o_orderstatus", ["O"])


@query(
    "cascade_delete",
    """SELECT l_partkey AS partkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem
      WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_name LIKE '____e%')""",
)
def _(spark, sf):
    tables = {
        "part": table(spark, sf, "part").withColumnRenamed("p_partkey", "partkey"),
        "lineitem": table(spark, sf, "lineitem").select(
            F.col("l_partkey").alias("partkey"), "l_orderkey", "l_linenumber", "l_shipdate"
        ),
    }
    return cascade_delete(tables, "part", F.col("p_name").like("____e%"), "partkey")["lineitem"]


@query(
    "cascade_delete_parent",
    "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '____e%'",
)
def _(spark, sf):
    tables = {"part": table(spark, sf, "part").select("p_partkey", "p_name")}
    return cascade_delete(tables, "part", F.col("p_name").like("____e%"), "p_partkey")["part"]


def _projects(spark, sf):
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("cod_projeto"), F.col("n_name").alias("nme_projeto")
    )


@query(
    "project_folders",
    """SELECT DISTINCT n_nationkey AS cod_projeto, n_name AS nme_projeto,
      concat(n_nationkey, '_', n_name) AS project_label, c_mktsegment AS pasta
      FROM nation JOIN customer ON c_nationkey = n_nationkey""",
)
def _(spark, sf):
    folders = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("cod_projeto"), F.col("c_mktsegment").alias("pasta")
    )
    return project_folders(_projects(spark, sf), folders)


@query(
    "project_owners",
    """SELECT n_nationkey AS cod_projeto, n_name AS nme_projeto,
      concat(n_nationkey, '_', n_name) AS project_label
      FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)""",
)
def _(spark, sf):
    folders = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("cod_projeto"))
    return project_folders(_projects(spark, sf), folders, with_folder=False)


@query(
    "project_label",
    """SELECT n_nationkey AS cod_projeto, n_name AS nme_projeto,
      concat(n_nationkey, '_', n_name) AS project_label FROM nation WHERE n_nationkey = 7""",
)
def _(spark, sf):
    return project_label(_projects(spark, sf), 7)


@query(
    "snapshot_history",
    """SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (
      SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
      WHERE l_returnflag NOT IN ('R') AND CAST(l_shipdate AS DATE) =
        (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem))""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_returnflag"
    )
    records = items.join(orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    return snapshot_history(
        orders, records, ["o_custkey"], "l_shipdate", "l_returnflag", ["R"]
    )


@query(
    "latest_batch",
    """SELECT event_id, user_id, ts, event_type FROM events WHERE user_id IN (
      SELECT user_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events))""",
)
def _(spark, sf):
    rows = _events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    return latest_batch(rows, "user_id", "ts")


@query(
    "history_window",
    """SELECT event_id, ts, event_type FROM events
      WHERE ts >= TIMESTAMP '2024-01-22 00:00:00' AND event_type NOT IN ('error')""",
)
def _(spark, sf):
    rows = _events(spark, sf).select("event_id", "ts", "event_type")
    return history_window(rows, "2024-01-25 04:00:00", "ts", "event_type", 3, ["error"])


@query(
    "file_record_history",
    """WITH recent AS (SELECT user_id AS id, arg_max(event_type, event_id) AS type,
        max(event_id) AS size FROM events
        WHERE ts >= TIMESTAMP '2024-01-22 00:00:00' AND event_type <> 'error' GROUP BY 1),
      hist AS (SELECT user_id AS id, 'old' AS type, min(event_id) AS size FROM events
        WHERE ts < TIMESTAMP '2024-01-22 00:00:00' GROUP BY 1)
      SELECT coalesce(r.id, h.id) AS id, coalesce(r.type, h.type) AS type,
        coalesce(r.size, h.size) AS size FROM hist h FULL JOIN recent r ON h.id = r.id""",
)
def _(spark, sf):
    rows = _events(spark, sf)
    hist = (
        rows.filter(F.col("ts") < F.lit("2024-01-22").cast("timestamp_ntz"))
        .groupBy(F.col("user_id").alias("id"))
        .agg(F.lit("old").alias("type"), F.min("event_id").alias("size"))
    )
    recent = history_window(rows, "2024-01-25 04:00:00", "ts", "event_type", 3, ["error"]).select(
        F.col("user_id").alias("id"), F.col("event_type").alias("type"),
        F.col("event_id").alias("size"),
    )
    return upsert(hist, recent, ["id"], ["size"])


@query(
    "current_batch",
    "SELECT event_id, ts, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'",
)
def _(spark, sf):
    rows = _events(spark, sf).select("event_id", "ts", "value")
    return current_batch(rows, "2024-01-10 09:00:00", "ts")


@query(
    "slice_of",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P')",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return slice_of(orders, "o_orderstatus", ["O", "P"])


_PART_NAME = """(CASE p_partkey % 8 WHEN 0 THEN concat('AGG_', p_name)
    WHEN 1 THEN concat('lkp_', p_name) WHEN 2 THEN concat('ff_', p_name)
    WHEN 3 THEN 'BI_CTRL_TRANSFORMACAO' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE p_name END)"""


@query(
    "naming_anomalies",
    f"""SELECT p_brand AS "CodOnda", 5000 AS "InconsistencyCode", {_NOTE} AS "Note",
      p_type AS "ProcessName", 'Map' AS "ObjectType", CAST(p_size AS VARCHAR) AS "CodProcess",
      {_RUN} AS "DateIns" FROM (SELECT *, {_PART_NAME} AS name FROM part)
      WHERE name IS NOT NULL AND name NOT IN ('', 'BI_CTRL_TRANSFORMACAO') AND NOT regexp_matches(
        lower(name), '^(ff|agg|exp|fil|jnr|rtr|seq|str|trc|uni|srt|nor|tgt|src|lkp)_')""",
)
def _(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_brand").alias("CodOnda"),
        F.col("p_type").alias("content_name"),
        F.col("p_size").cast("string").alias("CodProcess"),
        F.expr(_PART_NAME).alias("name"),
    )
    return naming_anomalies(rows, RUN_TS)


@query(
    "clean_columns",
    """SELECT n_nationkey AS "Cod_Nacao", n_name AS "Nome_curto", n_regionkey AS "Regiao_x"
      FROM nation""",
)
def _(spark, sf):
    return clean_columns(table(spark, sf, "nation").toDF("Cod. Nacao", "Nome (curto)", "Regiao x."))


@query(
    "rename_rules",
    """SELECT s_suppkey AS "RECEITA_UME", s_name AS "DSSGER", s_nationkey, s_acctbal
      FROM supplier""",
)
def _(spark, sf):
    sheet = table(spark, sf, "supplier").toDF("UME_TRAFEGO", "TCOGER", "s_nationkey", "s_acctbal")
    return apply_rename_rules(sheet, "684")


@query(
    "nan_to_null",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN l_quantity END AS q
      FROM lineitem""",
)
def _(spark, sf):
    q = F.expr("CASE WHEN l_tax > 0 THEN l_quantity ELSE double('NaN') END")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", q.alias("q"))
    return nan_to_null(rows)
