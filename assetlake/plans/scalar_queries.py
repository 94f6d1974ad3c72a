"""Queries on the column helpers: codes, ids, times and JSON coercions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    asset_name,
    brazil_time,
    class_int,
    codes_by_digits,
    codes_by_position,
    codes_by_type,
    federated_id,
    flag01,
    flag_text,
    input_sorted_text,
    is_true_literal,
    json_or_default,
    json_or_null,
    json_text,
    strip_at,
    text_or_empty,
    truthy,
    ts_from_iso,
    ts_from_millis,
    ts_from_xml,
    typed,
    value_to_string,
)
from ..functions.nodes import member
from ..sources.paths import with_path_columns
from .derived import wave_sql
from .registry import query
from .tables import table


@query(
    "codes_by_digits",
    r"""SELECT page_id, regexp_extract_all(url, '\d+')[1] AS wave,
        regexp_extract_all(url, '\d+')[2] AS process FROM pages""",
)
def _(spark, sf):
    wave, process = codes_by_digits(F.col("url"))
    return table(spark, sf, "pages").select("page_id", wave.alias("wave"), process.alias("process"))


_POSITION_NAME = f"""(CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 11 = 1 THEN 'a_b'
    WHEN o_orderkey % 11 = 2 THEN NULL ELSE concat('m_ld_x_', {wave_sql("o_custkey")}, '_',
    o_custkey % 100, '_z') END)"""


@query(
    "codes_by_position",
    f"""SELECT o_orderkey,
        CASE WHEN o_orderkey % 11 > 2 THEN {wave_sql("o_custkey")} END AS wave,
        CASE WHEN o_orderkey % 11 > 2 THEN CAST(o_custkey % 100 AS VARCHAR) END AS process
        FROM orders""",
)
def _(spark, sf):
    named = table(spark, sf, "orders").select("o_orderkey", F.expr(_POSITION_NAME).alias("name"))
    wave, process = codes_by_position(F.col("name"))
    return named.select("o_orderkey", wave.alias("wave"), process.alias("process"))


_TYPE = """(CASE event_id % 4 WHEN 0 THEN 'MTT' WHEN 1 THEN 'TASKFLOW'
    WHEN 2 THEN 'DTEMPLATE' ELSE 'OTHER' END)"""
_TAIL = """(CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '_' WHEN 2 THEN '_abc'
    ELSE concat('_', user_id) END)"""


@query(
    "codes_by_type",
    f"""SELECT event_id,
        CASE WHEN good THEN CAST(wave AS INTEGER) ELSE 0 END AS wave,
        CASE WHEN good AND event_id % 5 > 2 THEN CAST(user_id AS INTEGER) ELSE 0 END AS process
        FROM (SELECT *, {wave_sql("user_id")} AS wave,
          {wave_sql("user_id")} IN ('653', '673', '674', '684', '702') AND event_id % 5 <> 2 AS good
          FROM events)""",
)
def _(spark, sf):
    lead = f"(CASE WHEN {_TYPE} = 'TASKFLOW' THEN 'tf_' ELSE 'm_a_b_' END)"
    named = table(spark, sf, "events").select(
        "event_id",
        F.expr(f"concat({lead}, {wave_sql('user_id')}, {_TAIL})").alias("name"),
        F.expr(_TYPE).alias("type"),
    )
    wave, process = codes_by_type(F.col("name"), F.col("type"))
    return named.select("event_id", wave.alias("wave"), process.alias("process"))


@query(
    "strip_at_id",
    """SELECT o_orderkey,
        CASE o_orderkey % 4 WHEN 2 THEN concat('@', o_orderkey) WHEN 3 THEN concat('x', o_orderkey)
          ELSE CAST(o_orderkey AS VARCHAR) END AS stripped,
        CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey END AS number,
        CASE WHEN o_custkey % 3 = 0 THEN '' ELSE concat('saas:@', o_custkey) END AS federated
        FROM orders""",
)
def _(spark, sf):
    raw = F.expr(
        "concat(CASE o_orderkey % 4 WHEN 0 THEN '@' WHEN 1 THEN '' WHEN 2 THEN '@@'"
        " ELSE '@x' END, o_orderkey)"
    )
    federated = F.expr("CASE WHEN o_custkey % 3 = 0 THEN '' ELSE string(o_custkey) END")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        strip_at(raw).alias("stripped"),
        strip_at(raw).try_cast("bigint").alias("number"),
        federated_id(federated).alias("federated"),
    )


@query(
    "asset_names",
    """SELECT p_partkey, concat(p_name, '_', p_partkey) AS asset,
        concat('684_', p_brand) AS project_label, '684' AS "CodOnda", p_type AS folder FROM part""",
)
def _(spark, sf):
    path = F.expr(
        r"concat('base\\684_', p_brand, '/Explore/684_', p_brand, '/', p_type, '/',"
        " p_name, '_', p_partkey, '.DTEMPLATE.zip')"
    )
    named = table(spark, sf, "part").select("p_partkey", path.alias("source_path"))
    return with_path_columns(named).select(
        "p_partkey",
        asset_name(F.col("source_path"), ".DTEMPLATE.zip").alias("asset"),
        "project_label",
        "CodOnda",
        "folder",
    )


@query(
    "time_millis_pair",
    """SELECT event_id, date_trunc('millisecond', ts) AS utc,
        date_trunc('millisecond', ts) - INTERVAL 3 HOUR AS brazil FROM events""",
)
def _(spark, sf):
    millis = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    utc = ts_from_millis(millis)
    return table(spark, sf, "events").select(
        "event_id", utc.alias("utc"), brazil_time(utc).alias("brazil")
    )


_ISO_TEXT = """(CASE o_orderkey % 9 WHEN 0 THEN concat(iso, 'Z') WHEN 1 THEN iso
    WHEN 2 THEN concat(iso, '.250Z') WHEN 3 THEN concat(iso, '+02:00')
    WHEN 4 THEN concat(iso, '-0330') WHEN 5 THEN '' WHEN 6 THEN 'never' WHEN 7 THEN NULL
    ELSE replace(substring(iso, 1, 10), '-', '') END)"""
_ISO_VALUE = """CASE o_orderkey % 9 WHEN 0 THEN moment WHEN 1 THEN moment WHEN 2 THEN moment
    WHEN 3 THEN moment - INTERVAL 2 HOUR WHEN 4 THEN moment + INTERVAL 210 MINUTE
    WHEN 8 THEN date_trunc('day', moment) END"""
_AT = "(SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS moment FROM orders)"


def _iso_orders(spark, sf):
    return table(spark, sf, "orders").withColumn(
        "iso",
        F.expr(
            "date_format(timestampadd(SECOND, o_orderkey % 86400, o_orderdate),"
            " \"yyyy-MM-dd'T'HH:mm:ss\")"
        ),
    )


@query(
    "time_iso_default",
    f"""SELECT o_orderkey, v AS utc, v - INTERVAL 3 HOUR AS brazil FROM (SELECT o_orderkey,
        coalesce({_ISO_VALUE}, TIMESTAMP '1990-01-01 00:00:00') AS v FROM {_AT})""",
)
def _(spark, sf):
    utc = ts_from_iso(F.expr(_ISO_TEXT), "1990-01-01 00:00:00")
    return (
        _iso_orders(spark, sf)
        .select("o_orderkey", utc.alias("utc"))
        .withColumn("brazil", brazil_time(F.col("utc")))
    )


@query(
    "time_iso_null",
    f"""SELECT o_orderkey, v AS utc, v - INTERVAL 3 HOUR AS brazil
        FROM (SELECT o_orderkey, {_ISO_VALUE} AS v FROM {_AT})""",
)
def _(spark, sf):
    return (
        _iso_orders(spark, sf)
        .select("o_orderkey", ts_from_iso(F.expr(_ISO_TEXT)).alias("utc"))
        .withColumn("brazil", brazil_time(F.col("utc")))
    )


@query(
    "time_xml",
    f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN moment WHEN 1 THEN moment
        WHEN 2 THEN date_trunc('day', moment) END AS value FROM {_AT}""",
)
def _(spark, sf):
    text = F.expr(
        """CASE o_orderkey % 6 WHEN 0 THEN concat(iso, 'Z') WHEN 1 THEN iso
        WHEN 2 THEN substring(iso, 1, 10) WHEN 3 THEN concat(iso, '.5Z')
        WHEN 4 THEN '1900-01-01T00:00:00Z' ELSE '' END"""
    )
    return _iso_orders(spark, sf).select("o_orderkey", ts_from_xml(text).alias("value"))


@query(
    "text_or_empty",
    r"""SELECT doc_id, coalesce(regexp_replace(CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END,
        '^[\s\p{Z}\x0B\x{85}]+|[\s\p{Z}\x0B\x{85}]+$', '', 'g'), '') AS value FROM documents""",
)
def _(spark, sf):
    text = F.expr(
        r"CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat(' \t\n', text, '\r\n ') END"
    )
    return table(spark, sf, "documents").select("doc_id", text_or_empty(text).alias("value"))


# One JSON value per line item, its kind chosen by the row: 14 kinds and an absent key.
_KIND = "((l_orderkey + l_linenumber) % 15)"
_NODE_JSON = f"""(CASE {_KIND} WHEN 0 THEN 'true' WHEN 1 THEN 'false'
    WHEN 2 THEN CAST(l_linenumber % 2 AS string) WHEN 3 THEN concat(l_linenumber, '.50')
    WHEN 4 THEN concat(l_linenumber, '.0') WHEN 5 THEN '"Yes"' WHEN 6 THEN '" on "'
    WHEN 7 THEN concat('"', l_returnflag, '"') WHEN 8 THEN 'null' WHEN 9 THEN '{{}}'
    WHEN 10 THEN concat('{{"b":', l_partkey, ',"a":"', l_linestatus, '"}}')
    WHEN 11 THEN concat('[', l_suppkey, ', null]') WHEN 12 THEN concat('" [', l_suppkey, ']"')
    WHEN 13 THEN '"true"' END)"""


def _nodes(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .select(
            "l_orderkey",
            "l_linenumber",
            F.expr(f"concat('{{', coalesce(concat('\"v\":', {_NODE_JSON}), ''), '}}')").alias("j"),
        )
        .select(
            "l_orderkey",
            "l_linenumber",
            member(F.try_parse_json("j"), "v").alias("v"),
        )
    )


def _cases(*values: str | None) -> str:
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values) if v is not None)
    return f"CASE {_KIND} {cases} END"


_OBJECT = """concat('{"a":"', l_linestatus, '","b":', l_partkey, '}')"""
_ARRAY = "concat('[', l_suppkey, ',null]')"
_HALF = "concat(l_linenumber, '.5')"
_WHOLE = "concat(l_linenumber, '.0')"
_BIT = "CAST(l_linenumber % 2 AS VARCHAR)"
_TEXT = "l_returnflag"
_LISTED = "concat(' [', l_suppkey, ']')"
_SQL_NULL = "NULL"


def _node_query(name: str, helper, *expected: str | None) -> None:
    sql = f"SELECT l_orderkey, l_linenumber, {_cases(*expected)} AS value FROM lineitem"

    @query(name, sql)
    def _(spark, sf):
        return _nodes(spark, sf).select("l_orderkey", "l_linenumber", helper(F.col("v")).alias("value"))


_node_query(
    "flag01", flag01,
    "1", "0", "l_linenumber % 2", "1", "CASE WHEN l_linenumber = 0 THEN 0 ELSE 1 END", "1", "0",
    "0", "0", "0", "0", "0", "0", "1", "0",
)
_node_query(
    "flag_text", flag_text,
    "'true'", "'false'", "CASE l_linenumber % 2 WHEN 1 THEN 'true' ELSE 'false' END", "'true'",
    "CASE WHEN l_linenumber = 0 THEN 'false' ELSE 'true' END", "'true'", "'true'",
    "'false'", "'false'", "'false'", "'false'", "'false'", "'false'", "'true'", "'false'",
)
_node_query(
    "value_to_string_json", lambda v: value_to_string(v, "json"),
    "'true'", "'false'", _BIT, _HALF, _WHOLE, "'Yes'", "' on '", _TEXT, "''", "'{}'", _OBJECT,
    _ARRAY, _LISTED, "'true'", "''",
)
_node_query(
    "value_to_string_title", lambda v: value_to_string(v, "title"),
    "'True'", "'False'", _BIT, _HALF, _WHOLE, "'Yes'", "' on '", _TEXT, "''", "'{}'", _OBJECT,
    _ARRAY, _LISTED, "'true'", "''",
)
_node_query(
    "json_or_default", lambda v: json_or_default(v, "[]"),
    "'True'", "'False'", _BIT, _HALF, _WHOLE, """'"Yes"'""", """'" on "'""",
    """concat('"', l_returnflag, '"')""", "'[]'", "'{}'", _OBJECT, _ARRAY, _LISTED,
    """'"true"'""", "'[]'",
)
_node_query(
    "input_sorted", input_sorted_text,
    "'true'", "'false'", _BIT, _HALF, _WHOLE, "'Yes'", "' on '", _TEXT, "'None'", "'{}'", _OBJECT,
    _ARRAY, _LISTED, "'true'", "''",
)
_node_query(
    "is_true_literal", is_true_literal,
    *["FALSE"] * 13, "TRUE", "FALSE",
)
_node_query(
    "truthy", truthy,
    "TRUE", "FALSE", "l_linenumber % 2 = 1", "TRUE", "l_linenumber <> 0", "TRUE", "TRUE", "TRUE",
    "FALSE", "FALSE", "TRUE", "TRUE", "TRUE", "TRUE", "FALSE",
)
_node_query(
    "json_text", lambda v: json_text(v, "{}"),
    "'true'", "'false'", _BIT, _HALF, "CAST(l_linenumber AS VARCHAR)", """'"Yes"'""",
    """'" on "'""", """concat('"', l_returnflag, '"')""", "'null'", "'{}'", _OBJECT, _ARRAY,
    """concat('" [', l_suppkey, ']"')""", """'"true"'""", "'{}'",
)
_node_query(
    "json_or_null", json_or_null,
    "'true'", _SQL_NULL, "CASE l_linenumber % 2 WHEN 1 THEN '1' END", _HALF,
    "CASE WHEN l_linenumber <> 0 THEN CAST(l_linenumber AS VARCHAR) END", """'"Yes"'""",
    """'" on "'""", """concat('"', l_returnflag, '"')""", _SQL_NULL, _SQL_NULL, _OBJECT, _ARRAY,
    """concat('" [', l_suppkey, ']"')""", """'"true"'""", _SQL_NULL,
)
_node_query(
    "class_int", class_int,
    _SQL_NULL, _SQL_NULL, "l_linenumber % 2", _SQL_NULL, "l_linenumber", "0", "0", "0", _SQL_NULL,
    _SQL_NULL, _SQL_NULL, _SQL_NULL, "0", "0", "0",
)


@query(
    "props_field",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        'none' AS missing, CAST(NULL AS VARCHAR) AS nulled FROM events""",
)
def _(spark, sf):
    node = table(spark, sf, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return node.select(
        "event_id",
        typed(member(F.col("v"), "k"), "bigint").alias("k"),
        typed(member(F.col("v"), "absent"), default="none").alias("missing"),
        typed(member(F.parse_json(F.lit('{"n":null}')), "n"), default="none").alias("nulled"),
    )
