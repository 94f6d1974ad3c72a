"""Trees of many files are written, staged and deleted part by part."""

import json
from pathlib import Path

from conftest import mapping, rows_of, write_zip
from pyspark.sql import functions as F

from assetlake.operators.assets import derive_file_records
from assetlake.operators.quality import split_rejects
from assetlake.plans import catalog, jobs, scan_queries
from assetlake.plans.daily import run_daily
from assetlake.plans.derived import file_record_documents
from assetlake.sources.documents import flag_bad_json
from assetlake.sources.scratch import scratch_path
from assetlake.sources.store import TableStore

FLOW = """<types1:getItems xmlns:types1="http://schemas.active-endpoints.com/appmodules/repository/2010/10/avrepository.xsd"
  xmlns:ns0="http://schemas.active-endpoints.com/appmodules/screenflow/2010/10/avosScreenflow.xsd">
<types1:Item><types1:EntryId>{0}</types1:EntryId><types1:Name>tf__684_1</types1:Name>
<types1:Entry><ns0:taskflow name="n"/></types1:Entry></types1:Item></types1:getItems>"""


def deliver(base, days):
    """Each step puts packages of its own in place of those before; the lists stay."""
    root = base / "684_alpha"
    explore = root / "Explore" / "684_alpha"
    for number in days:
        member = {"x/1@3.bin": mapping(f"M{number}", "m_ld_x_684_77_a", [{"$$ID": f"T{number}", "name": "src_a"}])}
        write_zip(explore / "Fatos" / f"m{number}.DTEMPLATE.zip", member)
        flow = explore / "Geral" / f"f{number}.xml"
        if number > 1:  # the first delivery has no task flows and no connections
            flow.parent.mkdir(exist_ok=True)
            flow.write_text(FLOW.format(f"E{number}"))
            connection = {"@type": "connection", "id": f"@C{number}", "name": "db", "type": "Oracle"}
            write_zip(root / "SYS" / f"c{number}.Connection.zip", {"connection.json": json.dumps(connection)})
        (root / "list.csv").write_text("objectPath,objectName,objectType,id\n/a,m_a_b_684_9_x,DTEMPLATE,i1\n")
        yield number
        for file in root.rglob("*"):
            if file.suffix in (".zip", ".xml"):
                file.unlink()


def test_deliveries_are_staged_together_and_loaded_once(spark, tmp_path, monkeypatch):
    base, store = tmp_path / "exports", TableStore(spark, str(tmp_path / "tables"))
    projects = spark.createDataFrame([(684, "alpha")], "cod_projeto int, nme_projeto string")
    folders = spark.createDataFrame([(684, "Fatos")], "cod_projeto int, pasta string")

    stage, seen = jobs.stage_packages, []

    def failing(store, name, packages, more=False):
        seen.append(name)
        if seen.count("stage_connections") == 2 and name == "stage_connections":
            raise RuntimeError("broken delivery")
        return stage(store, name, packages, more)

    monkeypatch.setattr(jobs, "stage_packages", failing)
    written = run_daily(spark, store, str(base), projects, folders, [684], "2024-06-01 12:00:00", deliver(base, [1, 2, 3]))
    assert not [*base.rglob("*.zip"), *base.rglob("*.xml")]
    assert (written["stage_mappings"], written["stage_tasks"], written["stage_taskflows"]) == (3, 0, 2)
    assert rows_of(store.read("content"), "id") == [("M1",), ("M2",), ("M3",)]
    assert rows_of(store.read("transformation"), "id") == [("T1",), ("T2",), ("T3",)]
    assert rows_of(store.read("Item"), "EntryId") == [("E2",), ("E3",)]
    assert rows_of(store.read("ContentsofExportPackage"), "id") == [("i1",)]
    audit = rows_of(store.read("load_audit").where("table_name = 'maps'"), "table_name")
    assert audit == [("maps",)]
    # a kind that one delivery has not brought in whole is not staged
    assert seen.count("stage_connections") == 2 and written["stage_connections"] == 0
    assert rows_of(store.read("connections")) == []


def test_the_export_tree_holds_one_delivery_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan_queries, "_DEAL_FILES", 20)
    day = F.timestamp_seconds(F.lit(820454400)).alias("o_orderdate")
    orders = spark.range(40).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), day, F.lit("1-URGENT").alias("o_orderpriority")
    )
    orders = orders.union(orders.where("o_orderkey = 5"))  # one file, whatever the number of its rows
    customers = spark.range(10).selectExpr("id AS c_custkey", "'n' AS c_name", "int(id % 3) AS c_nationkey", "'m' AS c_mktsegment")
    documents = spark.range(7).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "'web' AS source")
    parts = spark.range(7).selectExpr("id AS p_partkey", "'p' AS p_name", "1 AS p_size")
    for name, rows in (("orders", orders), ("customer", customers), ("documents", documents), ("part", parts)):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    base = scratch_path(spark, "exports")
    folder, found, lists = Path(base.removeprefix("file:")), [], []
    for _ in scan_queries.export_tree(spark, str(tmp_path), base):
        files = [f for f in folder.rglob("*") if f.is_file()]
        found.append({str(f) for f in files if f.suffix in (".zip", ".xml")})
        lists.append(sorted(f.name for f in files if f.suffix in (".json", ".csv")))
    assert len(found) == 41 // 20 + 1 and all(found)
    assert sum(map(len, found)) == len(set().union(*found)) == 40 + 10 + 10  # no file in two, none left out
    assert max(map(len, found)) <= 45
    assert lists[0] == ["exportMetadata.v2.json"] * 7 + ["list.csv"] * 7 and all(names == lists[0] for names in lists)
    assert not [f for f in folder.rglob("*") if f.suffix in (".zip", ".xml")]


def test_record_files_are_there_one_deal_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan_queries, "_DEAL_FILES", 10, raising=False)
    events = spark.range(65).selectExpr("id AS event_id", "timestamp_ntz '2024-01-20 00:00:00' AS ts", "id % 6 AS user_id", "'click' AS event_type")
    events.union(events.where("event_id = 11")).write.parquet(f"{tmp_path}/events.parquet")
    scan, at_once = scan_queries.scan_json_documents, []

    def counted(spark, paths):
        at_once.append(sum(len(list(Path(p.removeprefix("file:")).iterdir())) for p in paths))
        return scan(spark, paths)

    monkeypatch.setattr(scan_queries, "scan_json_documents", counted)
    got = rows_of(catalog.QUERIES["scan_json_records"](spark, str(tmp_path)))
    assert len(at_once) == 7 and sum(at_once) == 65 and max(at_once) <= 20
    docs = file_record_documents(spark, str(tmp_path)).distinct()
    assert got == rows_of(derive_file_records(split_rejects(flag_bad_json(docs))[0]).drop("source_path", "_pos")) and got
    rejects = catalog.QUERIES["scan_json_rejects"](spark, str(tmp_path))
    assert rows_of(rejects, "file") == sorted([(f"{i}.json",) for i in range(65) if i % 5 == 4], key=repr)
