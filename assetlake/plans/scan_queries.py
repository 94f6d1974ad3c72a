"""Queries that write files of the export format to the shared folder and scan them from there."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assets import derive_file_records
from ..operators.quality import split_rejects
from ..sources import archives, sheets
from ..sources.documents import scan_json_documents
from ..sources.paths import asset_paths, existing_paths, project_folders, with_path_columns
from ..sources.scratch import scratch_path, stored_together
from ..sources.store import TableStore
from . import jobs
from .daily import EXPORT_LIST, run_daily
from .derived import (
    ORDER_WAVE,
    RUN_TS,
    WAVES,
    connection_documents,
    export_documents,
    file_record_documents,
    mapping_documents,
    package_rows,
    removed,
    wave_sql,
    written,
    zipped,
)
from .registry import CHECKS, query
from .source_queries import _taskflow_texts, workbooks
from .tables import table


_FOLDER_FILES = 5000  # files in one folder, about
# Files that are dealt out at once, about: each takes a block of the disk and an entry of its file table,
# and files deleted before the disk has got them cost much less.
_DEAL_FILES = 200_000


def _folder(folders: int) -> Column:
    """The number of the folder that a file lies in."""
    return F.pmod(F.xxhash64("source_path"), F.lit(folders))


def _spread_packages(rows: DataFrame, member: str, suffix: str, folders: int) -> DataFrame:
    """Rows (``source_path``, ``body``) as packages, packed by all tasks, not by the few that read a small table.

    There are as many tasks as folders at least, so a task does not grow with the table.  Rows of one path
    stay together, so that no two tasks write one file.
    """
    dealt = rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, folders), "source_path")
    place = F.concat(_folder(folders), F.lit("/"), "source_path")
    return zipped(dealt.withColumn("source_path", place), member, suffix)


def _scanned_packages(spark: SparkSession, packages: DataFrame, folders: int, name: str, suffix: str, ending: str) -> DataFrame:
    """Packages written and scanned; their folders are listed by a task each."""
    base = written(packages, scratch_path(spark, name))
    paths = existing_paths(spark, [f"{base}/{i}" for i in range(folders)])
    return archives.scan_archives(spark, paths or base, suffix, ending).drop("source_path")


def _scan_query(name: str, kind: tuple[str, str], source: str, key: str, text: str) -> None:
    """Packages of one kind written and scanned; every ninth is broken."""
    suffix, ending = kind

    @query(f"scan_{name}", CHECKS[f"archive_{name}"])
    def _(spark, sf):
        rows = table(spark, sf, source).select(
            F.expr(f"concat('a', {key})").alias("source_path"),
            F.when(F.expr(f"{key} % 9 <> 4"), F.col(text)).alias("body"),
        )
        folders = rows.count() // _FOLDER_FILES + 1
        packages = _spread_packages(rows, f"inner/{ending}", suffix, folders)
        # a file without a byte is no row of any scan, so a broken package has some
        packages = packages.withColumn("content", F.when(F.length("content") > 0, F.col("content")).otherwise(F.lit(b"PK")))
        return _scanned_packages(spark, packages, folders, name, suffix, ending)


_scan_query("mappings", archives.MAPPINGS, "documents", "doc_id", "text")
_scan_query("file_records", archives.FILE_RECORDS, "benchmark", "item_id", "text")
_scan_query("connections", archives.CONNECTIONS, "pages", "page_id", "html")


@query("scan_tasks", CHECKS["archive_tasks"])
def _(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.expr("concat('a', conv_id, '_', turn)").alias("source_path"), F.col("text").alias("body")
    )
    suffix, ending = archives.TASKS
    folders = rows.count() // _FOLDER_FILES + 1
    return _scanned_packages(spark, _spread_packages(rows, ending, suffix, folders), folders, "tasks", suffix, ending)


def _scanned_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every record document written to a file and scanned; the files lie in as many folders as their number asks for.

    They are dealt: those of a deal are deleted when what was scanned of them is stored.
    """
    n = table(spark, sf, "events").count()
    deals = n // _DEAL_FILES + 1
    folders = n // deals // _FOLDER_FILES + 1
    place = F.replace(F.concat("source_path", F.lit(".json")), F.lit("records/"), F.concat(F.lit("records/"), _folder(folders), F.lit("/")))

    def scans() -> Iterator[DataFrame]:
        for deal in range(deals):
            docs = file_record_documents(spark, sf, (deal, deals))
            files = docs.select(place.alias("path"), F.col("body").cast("binary").alias("content"))
            base = f"{written(files, scratch_path(spark, 'json'))}/records"
            found = existing_paths(spark, [f"{base}/{i}" for i in range(folders)])
            yield scan_json_documents(spark, found)
            removed(spark, found)

    return stored_together(scans(), spark, "scanned")


@query("scan_json_records", CHECKS["file_records"])
def _(spark, sf):
    scanned = _scanned_records(spark, sf)
    return derive_file_records(split_rejects(scanned)[0]).drop("source_path", "_pos")


@query(
    "scan_json_rejects",
    """SELECT concat(event_id, '.json') AS file, 'not a JSON document' AS error FROM events WHERE event_id % 5 = 4""",
)
def _(spark, sf):
    scanned = _scanned_records(spark, sf)
    _, rejects = split_rejects(scanned)
    return rejects.select(F.substring_index("source_path", "/", -1).alias("file"), "error")


# Nations are the projects of an export tree; a third of their folders is missing.
_NATION = "concat(n_nationkey, '_', n_name)"


@query(
    "scan_project_folders",
    f"""SELECT {_NATION} AS project_label, CAST(n_nationkey AS VARCHAR) AS "CodOnda", concat('F', i) AS folder,
        concat('m', i) AS asset_name, {_NATION} AS body, CAST(NULL AS VARCHAR) AS error
      FROM nation, (SELECT unnest([0, 1, 2, 3, 4]) AS i)
      WHERE n_nationkey % 2 = 0 AND (n_nationkey + i) % 3 <> 0""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation")
    projects = nation.select(F.col("n_nationkey").alias("cod_projeto"), F.col("n_name").alias("nme_projeto"))
    places = projects.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("pasta", F.concat(F.lit("F"), "i"))
    label = F.concat_ws("_", "cod_projeto", "nme_projeto")
    packages = places.where((F.col("cod_projeto") + F.col("i")) % 3 != 0).select(
        F.concat(label, F.lit("/Explore/"), label, F.lit("/"), "pasta", F.lit("/m"), "i").alias("source_path"), label.alias("body")
    )
    suffix, ending = archives.MAPPINGS
    base = written(zipped(packages, ending, suffix), scratch_path(spark, "projects"))
    codes = [r[0] for r in nation.where("n_nationkey % 2 = 0").select("n_nationkey").collect()]  # the projects of one run
    paths = asset_paths(spark, base, project_folders(projects, places.select("cod_projeto", "pasta"), codes))
    scanned = archives.scan_archives(spark, paths, suffix, ending)
    return with_path_columns(scanned).select("project_label", "CodOnda", "folder", "asset_name", "body", "error")


@query(
    "job_standardization_sheet",
    """SELECT CAST(s_suppkey AS VARCHAR) AS "RECEITA_UME", s_name AS "DSSGER",
        CASE WHEN s_nationkey % 5 > 0 THEN CAST(s_nationkey AS VARCHAR) END AS "s_nationkey"
      FROM supplier""",
)
def _(spark, sf):
    """Workbooks of a hundred suppliers each; a missing number stands as NaN in them."""
    rows = table(spark, sf, "supplier").select(
        F.expr("s_suppkey div 100").alias("book"),
        F.array(
            F.col("s_suppkey").cast("string"),
            "s_name",
            F.expr("IF(s_nationkey % 5 > 0, CAST(s_nationkey AS string), 'NaN')"),
        ).alias("cells"),
    )
    books = rows.groupBy("book").agg(F.collect_list("cells").alias("rows"))
    files = workbooks(books, ["UME TRAFEGO", "(TCOGER)", "s_nationkey"], "book")
    folder = written(files, scratch_path(spark, "sheets"))
    store = TableStore(spark, scratch_path(spark, "tables"))
    jobs.load_standardization(store, sheets.scan_sheet(spark, f"{folder}/sheets"), "684")
    return store.read("padronizacao_migracao_684")


def export_tree(spark: SparkSession, sf: str, base: str) -> Iterator[None]:
    """The test tables as an export tree below ``base``: a project for each wave, with all kinds of files.

    Packages and task flows come in deliveries, a step each, and are deleted before the next; lists stay.
    """

    def root(wave: str) -> str:
        return f"concat({wave}, '_p', {wave})"

    def under(docs: DataFrame, wave: str, folder: str, key: str, suffix: str, member: str) -> None:
        label = root(wave)
        path = F.expr(f"concat({label}, '{folder}'" + (f", {label}, '/Fatos'" if folder == "/Explore/" else "") + f", '/', {key})")
        written(zipped(docs.select(path.alias("source_path"), "body"), member, suffix), base)

    listed = F.expr("from_json(body, 'exportedObjects array<string>')")["exportedObjects"]
    exports = export_documents(spark, sf).select("project", F.array_join(listed, ",").alias("objects")).groupBy("project")
    exports = exports.agg(F.concat(F.lit('{"exportedObjects":['), F.array_join(F.collect_list("objects"), ","), F.lit("]}")).alias("body"))
    exports = exports.select(F.expr(f"concat({root('project')}, '/{EXPORT_LIST}')").alias("path"), F.col("body").cast("binary").alias("content"))
    written(exports, base)
    lists = package_rows(spark, sf).withColumn("wave", F.expr(wave_sql("CAST(substring(id, 3) AS bigint)")))
    line = F.concat_ws(",", *[F.concat(F.lit('"'), c, F.lit('"')) for c in ("objectType", "id", "objectName", "objectPath")])
    text = F.concat(F.lit("objectType,id,objectName,objectPath\n"), F.array_join(F.collect_list(line), "\n"), F.lit("\n"))
    lists = lists.groupBy("wave").agg(text.cast("binary").alias("content"))
    written(lists.select(F.expr(f"concat({root('wave')}, '/list.csv')").alias("path"), "content"), base)

    def of_orders(deal: tuple[int, int]) -> None:
        orders = mapping_documents(spark, sf, keep=["o_orderkey", "o_custkey"], deal=deal)
        under(orders, ORDER_WAVE, "/Explore/", "o_orderkey", archives.MAPPINGS[0], f"x/1{archives.MAPPINGS[1]}")

    def of_customers(deal: tuple[int, int]) -> None:
        customers = connection_documents(spark, sf, deal).withColumn("c", F.substring_index("source_path", "/", -1).cast("long"))
        under(customers, wave_sql("c"), "/SYS", "c", archives.CONNECTIONS[0], archives.CONNECTIONS[1])
        flows = _taskflow_texts(spark, sf, deal).withColumn("wave", F.expr(wave_sql("c_custkey")))
        path = F.expr(f"concat({root('wave')}, '/Explore/', {root('wave')}, '/Geral/', c_custkey, '.xml')")
        written(flows.select(path.alias("path"), F.concat("head", "items", "tail").cast("binary").alias("content")), base)

    order_deals = table(spark, sf, "orders").count() // _DEAL_FILES + 1
    customer_deals = 2 * table(spark, sf, "customer").count() // _DEAL_FILES + 1  # two files each
    for i in range(max(order_deals, customer_deals)):
        if i < order_deals:
            of_orders((i, order_deals))
        if i < customer_deals:
            of_customers((i, customer_deals))
        yield
        removed(spark, [f"{base}/{w}_p{w}/{area}" for w in WAVES for area in (f"Explore/{w}_p{w}/Fatos", f"Explore/{w}_p{w}/Geral", "SYS")])


def _keyed(name: str, sql: str, columns: list[str]) -> str:
    texts = ", ".join(f"""coalesce(CAST("{c}" AS VARCHAR), '-')""" for c in columns)
    return f"SELECT '{name}' AS table_name, concat_ws('|', {texts}) AS row_text FROM ({sql})"


# The tables that the run is read back from, with the columns compared.
_DAILY = {
    "content": ("content_docs", ["id", "class", "CodOnda", "CodProcess", "name"], ""),
    "transformation": ("transformations", ["id", "name", "content_name", "CodOnda", "CodProcess"], 'WHERE "CodOnda" IS NOT NULL'),
    "transformation_session_properties": ("session_properties", ["id", "id_transf", "name", "value", "CodOnda"], 'WHERE "CodOnda" IS NOT NULL'),
    "transformation_data_adapter_object": ("adapter_objects", ["id", "id_data_adapter", "object_name", "path"], 'WHERE "CodOnda" IS NOT NULL'),
    "AnomalyInsightTable": ("naming_of_documents", ["Note", "ProcessName", "CodOnda"], 'WHERE "CodOnda" IS NOT NULL'),
    "connections": ("connections", ["id", "name", "port", "federatedId"], ""),
    "ContentsofExportPackage": ("package_contents", ["id", "CodOnda", "CodProcess", "objectPath", "objectType"], ""),
    "exported_objects": ("exported_objects", ["object_guid", "object_name", "cod_projeto", "cod_processo"], ""),
    "Item": ("taskflow_item", ["EntryId", "Name", "GUID"], ""),
    "Service": ("taskflow_service", ["EntryId", "ServiceId", "Title"], ""),
}


@query(
    "job_daily_run",
    " UNION ALL ".join(_keyed(name, f"SELECT * FROM ({CHECKS[check]}) {where}", columns) for name, (check, columns, where) in _DAILY.items()),
)
def _(spark, sf):
    base = scratch_path(spark, "exports")
    projects = spark.createDataFrame([(int(w), f"p{w}") for w in WAVES], "cod_projeto int, nme_projeto string")
    folders = projects.select("cod_projeto", F.explode(F.array(F.lit("Fatos"), F.lit("Missing"))).alias("pasta"))
    store = TableStore(spark, scratch_path(spark, "tables"))
    run_daily(spark, store, base, projects, folders, [int(w) for w in WAVES], RUN_TS, export_tree(spark, sf, base))
    rows = [
        store.read(name).select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("row_text"),
        )
        for name, (_, columns, _) in _DAILY.items()
    ]
    return reduce(DataFrame.unionAll, rows)
