"""All jobs end to end over a small export tree, run twice."""

import json

import pytest
from conftest import mapping, rows_of, write_zip

from assetlake.plans import jobs
from assetlake.plans.daily import run_daily
from assetlake.schemas import TABLES
from assetlake.sources.store import TableStore

DAY_1, DAY_2 = "2024-06-01 12:00:00", "2024-06-02 12:00:00"
FLOW = """<?xml version="1.0" encoding="UTF-8"?>
<types1:getItems
  xmlns:types1="http://schemas.active-endpoints.com/appmodules/repository/2010/10/avrepository.xsd"
  xmlns:ns0="http://schemas.active-endpoints.com/appmodules/screenflow/2010/10/avosScreenflow.xsd"
  xmlns:ns2="http://schemas.active-endpoints.com/appmodules/screenflow/2011/06/avosHostEnvironment.xsd">
<types1:CurrentServerDateTime>2024-05-01T10:20:30Z</types1:CurrentServerDateTime>
<types1:Item><types1:EntryId>{entry}</types1:EntryId><types1:Name>{name}</types1:Name>
<types1:Entry><ns0:taskflow name="{name}"><ns0:flow id="f"><ns0:eventContainer>
<ns0:service id="s"><ns0:title>{title}</ns0:title></ns0:service></ns0:eventContainer></ns0:flow>
<ns0:dependencies><ns2:processObject name="p"/><ns2:processObject name="p"/></ns0:dependencies>
</ns0:taskflow></types1:Entry></types1:Item></types1:getItems>"""


def transformation(number: int, name: str, **more):
    return {"$$ID": f"T{number}", "name": name, "createTime": "2024-01-02T03:04:05Z", **more}


def export_tree(base):
    root = base / "684_alpha"
    fatos = root / "Explore" / "684_alpha" / "Fatos"
    adapter = {"$$ID": "A1", "connectionId": "C1", "object": [{"$$ID": "O1", "$$class": "12"}]}
    props = {"sessionProperties": [{"$$ID": "S1", "name": "n", "value": True}]}
    advanced = [{"$$ID": "D1", "value": None}]
    items = [
        transformation(1, "src_a", sessionProperties=props, dataAdapter=adapter),
        transformation(2, "wrong", advancedProperties=advanced),
        transformation(2, "wrong again", advancedProperties=advanced),
    ]
    write_zip(
        fatos / "m1.DTEMPLATE.zip",
        {
            "x/1@3.bin": mapping("M1", "m_ld_x_684_77_a", items),
            "2@3.bin": "second match is not read",
            "fileRecord.json": json.dumps(
                [
                    {"@type": "fileRecord", "id": "@5", "name": "f_684_77.bin", "type": "BIN",
                     "size": 3, "attachTime": 1717243200000},
                    {"@type": "fileRecord", "id": "@6", "name": "f_684_77.png", "type": "IMAGE"},
                    {"@type": "fileRecord", "id": 7, "name": "number id"},
                ]
            ),
        },
    )
    (fatos / "broken.DTEMPLATE.zip").write_bytes(b"no zip")
    task = {
        "name": "mt_ld_x_684_77",
        "parameters": [{"id": "p1", "newObject": "YES"}],
        "sessionPropertiesList": {"name": "s", "value": "v", "recommended": 1},
    }
    write_zip(fatos / "t1.MTT.zip", {"mtTask.json": json.dumps(task)})
    connection = {"@type": "connection", "id": "@C1", "name": "db", "password": "x", "type": "Oracle"}
    write_zip(root / "SYS" / "c.Connection.zip", {"connection.json": json.dumps(connection)})
    (root / "list.csv").write_text(
        "objectPath,objectName,objectType,id\n"
        '"/a, b",m_a_b_684_9_x,DTEMPLATE,i1\n/c,tf_684_5,TASKFLOW,i2\n/d,x,Project,i3\n'
    )
    (root / "exportMetadata.v2.json").write_text(
        json.dumps({"exportedObjects": [
            {"objectName": "o_684_1", "metadata": {"additionalInfo": {"description": "d"}}},
            {"objectName": "o_702_1"}, {"objectName": "plain"}]})
    )
    geral = root / "Explore" / "684_alpha" / "Geral"
    geral.mkdir(parents=True)
    (geral / "f1.xml").write_text(FLOW.format(entry="E1", name="tf__684_1", title="one"))
    (geral / "f2.xml").write_text(FLOW.format(entry="E1", name="tf__684_1", title="two"))
    (geral / "bad.xml").write_text("<open>")
    return root


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("exports")
    root = export_tree(base)
    store = TableStore(spark, str(tmp_path_factory.mktemp("tables")))
    projects = spark.createDataFrame([(684, "alpha"), (702, "beta")], "cod_projeto int, nme_projeto string")
    folders = spark.createDataFrame(
        [(684, "Fatos"), (684, "Fatos"), (684, "Missing"), (684, "Geral"), (702, "Fatos")],
        "cod_projeto int, pasta string",
    )

    def run(day):
        return run_daily(spark, store, str(base), projects, folders, [684, 702], day)

    first = run(DAY_1)
    tables = {n: rows_of(store.read(n)) for n in TABLES}
    return {"store": store, "first": first, "tables": tables, "run": run, "root": root}


def test_first_run_counts(world):
    written = world["first"]
    assert written["stage_mappings"] == 2
    expected = {
        "content": 1, "transformation": 2, "transformation_session_properties": 1,
        "transformation_advanced_properties": 1, "transformation_data_adapter": 1,
        "transformation_data_adapter_object": 1, "AnomalyInsightTable": 1, "s_task": 1,
        "s_task_parameters": 1, "s_task_sessionPropertiesList": 1, "connections": 1,
        "transformation_file_records": 2, "transformation_file_records_hist": 0,
        "ContentsofExportPackage": 2, "exported_objects": 2, "Item": 1, "Entry": 1, "Flow": 1,
        "Service": 1, "Dependencies": 1, "transformation_hist": 0,
    }
    assert {k: written[k] for k in expected} == expected


def test_last_writer_wins(world):
    store = world["store"]
    assert rows_of(store.read("transformation"), "id", "name") == [("T1", "src_a"), ("T2", "wrong again")]
    assert rows_of(store.read("Service"), "Title") == [("two",)]


def test_values(world):
    store = world["store"]
    assert rows_of(store.read("transformation_session_properties"), "value") == [("True",)]
    assert rows_of(store.read("transformation_advanced_properties"), "name", "value") == [
        ("property_D1", "")
    ]
    assert rows_of(store.read("ContentsofExportPackage"), "id", "CodOnda", "CodProcess", "objectPath") == [
        ("i1", 684, 9, "/a, b"), ("i2", 684, 5, "/c")
    ]
    assert rows_of(store.read("exported_objects"), "object_name", "cod_projeto", "cod_processo") == [
        ("o_684_1", "684", "1"), ("plain", "684", None)
    ]
    assert rows_of(store.read("connections"), "id", "password") == [("C1", "***")]
    note = store.read("AnomalyInsightTable").first()["Note"]
    assert note.startswith("As 3 primeiras posições de wrong again devem")


def test_rejects_are_kept(world):
    good, bad = jobs.staged(world["store"], "maps")
    assert good.count() == 1
    assert rows_of(bad, "asset_name", "error") == [("broken", "corrupt archive")]


def test_audit_counts_sources(world):
    got = {r["table_name"]: r for r in jobs.staging_audit(world["store"]).collect()}
    assert (got["maps"]["sources"], got["maps"]["failed"]) == (2, 1)
    assert not got["maps"]["success"] and got["tasks"]["success"]
    assert (got[None]["records_read"], got[None]["failed"]) == (6, 2)


def test_second_run_is_idempotent_and_keeps_history(world):
    store, before = world["store"], world["tables"]
    written = world["run"](DAY_2)
    assert written["transformation_hist"] == 2
    assert written["transformation_file_records_hist"] == 1
    assert written["AnomalyInsightTable"] == 0
    for name in TABLES:
        if name.endswith("_hist"):
            continue
        after = store.read(name)
        stamps = [c for c in after.columns if c.lower().startswith(("dt_", "created_at"))]
        kept = [c for c in after.columns if c not in stamps]
        index = [after.columns.index(c) for c in kept]
        assert rows_of(after, *kept) == sorted(
            (tuple(r[i] for i in index) for r in before[name]), key=repr
        ), name
    content = store.read("content").first()
    assert str(content["Dt_Inserted"]) == DAY_1 and str(content["Dt_updated"]) == DAY_2


def test_emptied_slice_is_removed(world):
    store = world["store"]
    rows = store.read("transformation")
    assert store.replace_slices("transformation", rows.filter("false"), ["684"]) == 0
    assert store.read("transformation").count() == 0


def test_failed_staging_loads_nothing_of_an_earlier_day(world, monkeypatch):
    store = world["store"]
    before = rows_of(store.read("content"))
    stage = jobs.stage_packages

    def failing(store, name, packages):
        if name == "stage_mappings":
            raise RuntimeError("no packages today")
        return stage(store, name, packages)

    monkeypatch.setattr(jobs, "stage_packages", failing)
    written = world["run"]("2024-06-03 12:00:00")
    assert written["stage_mappings"] == 0
    assert rows_of(store.read("content")) == before
