"""Queries that read packages, task flows, sheets and lists derived from the test tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.taskflows import shred_taskflows
from ..schemas import TABLES, TASKFLOW_TABLES
from ..sources import archives, sheets
from ..sources.documents import scan_package_csv
from ..sources.scratch import scratch_path, stored
from ..sources.taskflow_xml import NAMESPACES, parse_taskflows, scan_taskflow_xml
from .derived import package_rows, wave_sql, zipped
from .registry import query
from .tables import dealt, spread, table


def _archive_query(name: str, kind: tuple[str, str], source: str, key: str, text: str) -> None:
    suffix, ending = kind
    empty = f"{text} IS NULL OR {text} = '' OR {key} % 9 = 4"
    sql = f"""SELECT concat('a', {key}) AS asset_name,
        CASE WHEN {empty} THEN NULL ELSE {text} END AS body,
        CASE WHEN {empty} THEN 'corrupt archive' END AS error FROM {source}"""

    @query(name, sql)
    def _(spark, sf):
        rows = spread(table(spark, sf, source)).select(
            F.concat(F.lit("x/a"), F.col(key)).alias("source_path"),
            F.when(F.col(key) % 9 != 4, F.col(text)).alias("body"),
        )
        packages = zipped(rows, f"inner/{ending}", suffix)
        return archives.unzip_members(packages, suffix, ending).drop("source_path")


_archive_query("archive_mappings", archives.MAPPINGS, "documents", "doc_id", "text")
_archive_query("archive_file_records", archives.FILE_RECORDS, "benchmark", "item_id", "text")
_archive_query("archive_connections", archives.CONNECTIONS, "pages", "page_id", "html")


@query(
    "archive_tasks",
    """SELECT concat('a', conv_id, '_', turn) AS asset_name, text AS body,
      CAST(NULL AS VARCHAR) AS error FROM conversations""",
)
def _(spark, sf):
    rows = spread(table(spark, sf, "conversations")).select(
        F.expr("concat('x/a', conv_id, '_', turn)").alias("source_path"), F.col("text").alias("body")
    )
    suffix, ending = archives.TASKS
    return archives.unzip_members(zipped(rows, ending, suffix), suffix, ending).drop("source_path")


@query(
    "archive_missing_member",
    """SELECT concat('a', item_id) AS asset_name, CAST(NULL AS VARCHAR) AS body,
      'member not found' AS error FROM benchmark""",
)
def _(spark, sf):
    rows = table(spark, sf, "benchmark").select(
        F.expr("concat('x/a', item_id)").alias("source_path"), F.col("text").alias("body")
    )
    packages = zipped(rows, "other.json", ".MTT.zip")
    return archives.unzip_members(packages, *archives.TASKS).drop("source_path")


def _taskflow_texts(spark, sf, deal: tuple[int, int] | None = None) -> DataFrame:
    """Head, items and tail of a task-flow file per customer (of the deal); its second item has an entry of its own."""
    n = NAMESPACES

    def one(name: str, value: str) -> str:
        return f"'<types1:{name}>', {value}, '</types1:{name}>'"

    operations = """'<ns0:operation source="o1" to="t1">v', c_nationkey, '</ns0:operation>'"""
    service = f"""'<ns0:service id="s1"><ns0:title> T', c_custkey, ' </ns0:title>',
        '<ns0:serviceName>', c_mktsegment, '</ns0:serviceName><ns0:serviceInput>',
        '<ns0:parameter name="p1" source="const">in', c_custkey, {operations},
        'after</ns0:parameter><ns0:parameter name="p2"/></ns0:serviceInput>',
        '<ns0:serviceOutput><ns0:operation source="a" to="b">', c_nationkey,
        '</ns0:operation><ns0:operation to="c"/></ns0:serviceOutput></ns0:service>'"""
    flow = f"""'<ns0:flow id="f1"><ns0:start id="b"><ns0:link targetId="s', c_nationkey,
        '"/></ns0:start><ns0:eventContainer id="e1">', {service},
        '</ns0:eventContainer><ns0:eventContainer id="e2"><ns0:service id="s2"/>',
        '</ns0:eventContainer></ns0:flow>'"""
    fields = """'<ns0:tempFields><ns0:field name="n1" type="string" description="d">',
        '<ns0:options><ns0:option name="k">', c_nationkey, '</ns0:option>',
        '<ns0:option name="e"/></ns0:options></ns0:field><ns0:field name="n2"/></ns0:tempFields>'"""
    deployment = """'<ns0:deployment skipIfRunning="true" suspendOnFault="TRUE">',
        '<ns0:tracingLevel> none </ns0:tracingLevel><ns0:allowedGroups><ns0:group> g1 </ns0:group>',
        '<ns0:group/><ns0:group>g', c_nationkey, '</ns0:group></ns0:allowedGroups></ns0:deployment>'"""
    dependencies = """'<ns0:dependencies><ns2:processObject name="', c_mktsegment, '"/>',
        '<ns2:processObject name="x"/><ns2:processObject name="x"/></ns0:dependencies>'"""
    taskflow = f"""'<types1:Entry><ns0:taskflow displayName="D" name="', c_name,
        '" overrideAPIName="True"><ns0:description> about ', c_custkey, '</ns0:description>',
        {fields}, {deployment}, {flow}, {dependencies}, '</ns0:taskflow></types1:Entry>'"""
    first = f"""'<types1:Item>', {one("EntryId", "' E', c_custkey, ' '")},
        {one("Name", f"'tf__', {wave_sql('c_custkey')}, '_', c_custkey")},
        {one("CreationDate", "'2024-02-03T04:05:06Z'")},
        {one("ModificationDate", "'1900-01-01T00:00:00Z'")},
        {one("PublicationDate", "'2024-02-03'")}, {one("GUID", "c_custkey")},
        IF(c_custkey % 4 = 0, '', concat({taskflow})), '</types1:Item>'"""
    second = f"""'<types1:Item>', {one("EntryId", "'E', c_custkey, 'b'")},
        '<types1:Entry><ns0:taskflow name="only"/></types1:Entry></types1:Item>',
        '<types1:Item>', {one("EntryId", "' '")}, {one("Name", "'nobody'")}, '</types1:Item>'"""
    head = (
        f"""'<?xml version="1.0" encoding="UTF-8"?><types1:getItems xmlns:types1="{n["types1"]}" """
        f"""xmlns:ns0="{n["ns0"]}" xmlns:ns2="{n["ns2"]}">'"""
    )
    server_time = one("CurrentServerDateTime", "'2024-05-01T10:20:30Z'")
    return spread(dealt(table(spark, sf, "customer"), "c_custkey", deal)).select(
        "c_custkey",
        F.expr(f"concat({head}, {server_time})").alias("head"),
        F.expr(f"concat({first}, {second})").alias("items"),
        F.expr("concat(IF(c_custkey % 10 = 3, '<open>', ''), '</types1:getItems>')").alias("tail"),
    )


def _taskflow_files(spark, sf) -> DataFrame:
    """One task-flow file per customer; every tenth is broken."""
    return _taskflow_texts(spark, sf).select(
        F.expr("concat('flows/', c_custkey, '.xml')").alias("path"),
        F.concat("head", "items", "tail").cast("binary").alias("content"),
    )


def _taskflow_folder(spark, sf) -> str:
    """A folder of task-flow files with the items of many customers each; the items of a broken file come in it."""
    texts = _taskflow_texts(spark, sf).withColumn("file", F.expr("concat(c_custkey % 10, '-', c_custkey div 5000)"))
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "items"))), lambda x: x["items"]), "\n")
    files = texts.groupBy("file").agg(F.concat(F.first("head"), items, F.first("tail")).alias("text"))
    path = scratch_path(spark, "flows")
    files.write.partitionBy("file").text(path)
    return path


_GOOD = "FROM customer WHERE c_custkey % 10 <> 3"
_FLOWS = f"{_GOOD} AND c_custkey % 4 <> 0"
_E = """concat('E', c_custkey) AS "EntryId" """
_EMPTY_TEXTS = [
    "MimeType", "Description", "AppliesTo", "Tags", "VersionLabel", "State", "ProcessGroup",
    "CreatedBy", "ModifiedBy", "PublicationStatus", "PublishedBy", "PublishedContributionId",
    "DisplayName",
]
_BLANKS = ", ".join(f"""'' AS "{c}" """ for c in _EMPTY_TEXTS)
_SERVER = """TIMESTAMP '2024-05-01 10:20:30' AS "CurrentServerDateTime" """

_TASKFLOW_SQL = {
    "Item": f"""SELECT {_E}, concat('tf__', {wave_sql("c_custkey")}, '_', c_custkey) AS "Name",
        TIMESTAMP '2024-02-03 04:05:06' AS "CreationDate",
        CAST(NULL AS TIMESTAMP) AS "ModificationDate",
        TIMESTAMP '2024-02-03 00:00:00' AS "PublicationDate", CAST(c_custkey AS VARCHAR) AS "GUID",
        {_BLANKS}, {_SERVER} {_GOOD}
      UNION ALL BY NAME SELECT concat('E', c_custkey, 'b') AS "EntryId", '' AS "Name",
        CAST(NULL AS TIMESTAMP) AS "CreationDate", CAST(NULL AS TIMESTAMP) AS "ModificationDate",
        CAST(NULL AS TIMESTAMP) AS "PublicationDate", '' AS "GUID", {_BLANKS}, {_SERVER} {_GOOD}""",
    "Entry": f"""SELECT {_E}, 'D' AS "DisplayName", c_name AS "EntryName", 1 AS "OverrideAPIName",
        concat('about ', c_custkey) AS "Description", '' AS "Tags", '' AS "Generator" {_FLOWS}
      UNION ALL SELECT concat('E', c_custkey, 'b'), '', 'only', 0, '', '', '' {_GOOD}""",
    "TempFields": f"""SELECT {_E}, 'd' AS "Description", 'n1' AS "Name", 'string' AS "Type",
        concat('k: ', c_nationkey, '; e: ') AS "Options" {_FLOWS}
      UNION ALL SELECT {_E}, '', 'n2', '', '' {_FLOWS}""",
    "Deployment": f"""SELECT {_E}, 1 AS "SkipIfRunning", 0 AS "SuspendOnFault",
        'none' AS "TracingLevel", concat('g1, g', c_nationkey) AS "AllowedGroups" {_FLOWS}""",
    "Flow": f"""SELECT {_E}, 'f1' AS "FlowId", 'b' AS "StartId",
        concat('s', c_nationkey) AS "StartTargetId" {_FLOWS}""",
    "Service": f"""SELECT {_E}, 's1' AS "ServiceId", concat('T', c_custkey) AS "Title",
        c_mktsegment AS "ServiceName", '' AS "ServiceGUID" {_FLOWS}
      UNION ALL SELECT {_E}, 's2', '', '', '' {_FLOWS}""",
    "ServiceInput": f"""SELECT {_E}, 's1' AS "ServiceId", 'p1' AS "ParameterName",
        'const' AS "Source", concat('in', c_custkey) AS "Value" {_FLOWS}
      UNION ALL SELECT {_E}, 's1', 'p2', '', '' {_FLOWS}""",
    "ServiceOperation": f"""SELECT {_E}, 's1' AS "ServiceId", 'p1' AS "ParameterName",
        'o1' AS "OperationSource", 't1' AS "OperationTarget",
        concat('v', c_nationkey) AS "Value" {_FLOWS}""",
    "ServiceOutput": f"""SELECT {_E}, 's1' AS "ServiceId", 'a' AS "OperationSource",
        'b' AS "OperationTarget", CAST(c_nationkey AS VARCHAR) AS "Value" {_FLOWS}
      UNION ALL SELECT {_E}, 's1', '', 'c', '' {_FLOWS}""",
    "Dependencies": f"""SELECT {_E}, c_mktsegment AS "ProcessObject" {_FLOWS}
      UNION ALL SELECT {_E}, 'x' {_FLOWS} UNION ALL SELECT {_E}, 'x' {_FLOWS}""",
}


def _taskflow_query(name: str) -> None:
    @query(f"taskflow_{name.lower()}", _TASKFLOW_SQL[name])
    def _(spark, sf):
        items = scan_taskflow_xml(spark, _taskflow_folder(spark, sf), "*.txt")
        return shred_taskflows(items)[name].select(*TABLES[name].columns)


for _table_name in TASKFLOW_TABLES:
    _taskflow_query(_table_name)


@query(
    "taskflow_rejects",
    """SELECT concat('flows/', c_custkey, '.xml') AS source_path FROM customer
      WHERE c_custkey % 10 = 3""",
)
def _(spark, sf):
    items = parse_taskflows(_taskflow_files(spark, sf))
    return items.filter(F.col("error").isNotNull()).select("source_path")


# The parts of a minimal workbook; data rows go where the mark is.
_BOOK_PARTS = {
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
    '<sheet name="one" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": "<Relationships xmlns="
    '"http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" '
    'Type="worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
_SHEET_HEAD = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'


def _workbook(rows: list[list[str | None]]) -> bytes:
    cells = []
    for r, row in enumerate(rows, 1):
        filled = "".join(
            f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{escape(text)}</t></is></c>'
            for c, text in enumerate(row)
            if text is not None
        )
        cells.append(f'<row r="{r}">{filled}</row>')
    sheet = f"{_SHEET_HEAD}{''.join(cells)}</sheetData></worksheet>"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        for name, part in {**_BOOK_PARTS, "xl/worksheets/sheet1.xml": sheet}.items():
            book.writestr(name, part)
    return buffer.getvalue()


def workbooks(books: DataFrame, header: list[str], key: str) -> DataFrame:
    """``path, content`` of a workbook for each row: the header and ``rows``, an array of text cells each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_workbook([header, *rows]) for rows in batch.column("rows").to_pylist()]
            paths = [f"sheets/{k}.xlsx" for k in batch.column(key).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(made, pa.binary())], names=["path", "content"])

    return books.select(key, "rows").mapInArrow(pack, "path string, content binary")


@query(
    "sheet_scan",
    """SELECT CAST(p_partkey AS VARCHAR) AS "Cod. Part", p_name AS "Nome (part)",
      CASE WHEN p_size % 2 = 0 THEN p_type END AS "Tipo" FROM part""",
)
def _(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.array(F.array(F.col("p_partkey").cast("string"), "p_name", F.expr("CASE WHEN p_size % 2 = 0 THEN p_type END"))).alias("rows"),
    )
    books = workbooks(spread(parts), ["Cod. Part", "Nome (part)", "Tipo"], "p_partkey")
    return sheets.sheet_frame(stored(sheets.read_cells(books), "sheets")).drop("source_path", "row")


@query(
    "package_csv",
    f"""SELECT concat('id', p_partkey) AS id, concat('/Explore/', p_name) AS "objectPath",
      concat(CASE WHEN p_partkey % 4 = 1 THEN 'tf_' ELSE 'm_a_b_' END, {wave_sql("p_partkey")},
        '_', p_size) AS "objectName",
      CASE p_partkey % 4 WHEN 0 THEN 'MTT' WHEN 1 THEN 'TASKFLOW' WHEN 2 THEN 'DTEMPLATE'
        ELSE 'Project' END AS "objectType", CAST(NULL AS VARCHAR) AS error FROM part""",
)
def _(spark, sf):
    path = scratch_path(spark, "package-csv")
    package_rows(spark, sf).write.csv(path, header=True, quoteAll=True, escape='"')
    return scan_package_csv(spark, path).drop("source_path", "_pos")
