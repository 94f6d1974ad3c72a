"""Published tables: all or nothing, parts that stay, tasks and buckets that grow, merges without a shuffle."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from assetlake.plans import jobs, source_queries
from assetlake.operators.merge import collapse_batch, upsert_table
from assetlake.schemas import TABLES, TASKFLOW_TABLES
from assetlake.sources import store as store_module
from assetlake.sources.store import TableStore
from assetlake.sources.taskflow_xml import parse_taskflows


def flow_rows(spark, values):
    return spark.createDataFrame([(k, "f", "s", v) for k, v in values], TABLES["Flow"].schema)


def contents(store, names):
    return {n: rows_of(store.read(n)) for n in names}


def test_a_failed_load_leaves_all_tables_as_they_were(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    files = source_queries._taskflow_files(spark, "/root/testdata/sf0.001")
    jobs.load_taskflows(store, parse_taskflows(files.where("path like '%1.xml'")), ["684"])
    before = contents(store, TASKFLOW_TABLES)
    write, written = TableStore._write, []

    def failing(self, name, *more):
        if name in TASKFLOW_TABLES:
            written.append(name)
            if len(written) == 6:
                raise OSError("disk full")
        return write(self, name, *more)

    monkeypatch.setattr(TableStore, "_write", failing)
    with pytest.raises(OSError):
        jobs.load_taskflows(store, parse_taskflows(files), ["684"])
    monkeypatch.undo()
    assert len(written) >= 6 and contents(store, TASKFLOW_TABLES) == before
    jobs.load_taskflows(store, parse_taskflows(files), ["684"])
    after = contents(store, TASKFLOW_TABLES)
    assert all(len(after[n]) > len(before[n]) for n in TASKFLOW_TABLES)
    # the same from nothing, so what failed has left no trace
    fresh = TableStore(spark, str(tmp_path / "fresh"))
    jobs.load_taskflows(fresh, parse_taskflows(files), ["684"])
    assert contents(fresh, TASKFLOW_TABLES) == after


def test_a_crash_before_the_marker_keeps_rows_the_batch_did_not_hold(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path), buckets=2)
    store.upsert("Flow", flow_rows(spark, [(f"E{i}", str(i)) for i in range(40)]), ["FlowId"])
    before = rows_of(store.read("Flow"))
    monkeypatch.setattr(TableStore, "_publish", lambda self: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        store.upsert("Flow", flow_rows(spark, [("E1", "new")]), ["FlowId"])
    monkeypatch.undo()
    assert rows_of(store.read("Flow")) == before
    again = TableStore(spark, str(tmp_path), buckets=2)
    again.upsert("Flow", flow_rows(spark, [("E1", "new")]), ["FlowId"])
    assert dict(rows_of(again.read("Flow"), "EntryId", "StartTargetId"))["E1"] == "new"
    assert again.read("Flow").count() == 40


def test_two_loads_of_one_number_do_not_both_publish(spark, tmp_path):
    one, two = TableStore(spark, str(tmp_path)), TableStore(spark, str(tmp_path))
    with pytest.raises(RuntimeError, match="another load"), one.publication():
        one.overwrite("mine", spark.range(3))
        two.overwrite("yours", spark.range(2))
    assert two.read("yours").count() == 2
    with pytest.raises(ValueError):
        two.read("mine")


def test_readers_of_an_earlier_state_stay_whole(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), keep=2)
    store.overwrite("x", spark.range(5))
    earlier = store.read("x")
    store.overwrite("x", spark.range(9))
    assert earlier.count() == 5 and store.read("x").count() == 9
    store.overwrite("x", spark.range(2))
    assert len([p for p in (tmp_path / "x").iterdir()]) == 2


def test_slices_and_appends(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "_MOST_FOLDERS", 3)
    store = TableStore(spark, str(tmp_path))
    schema = TABLES["exported_objects"].schema

    def rows(*waves):
        return spark.createDataFrame([(f"g{w}", None, None, None, None, None, None, None, w, None, None) for w in waves], schema)

    assert store.replace_slices("exported_objects", rows("a/b", "684"), ["a/b", "684"]) == 2
    assert store.replace_slices("exported_objects", rows("702"), ["a/b", "702"]) == 1
    assert rows_of(store.read("exported_objects"), "object_guid", "cod_projeto") == [("g684", "684"), ("g702", "702")]
    for i in range(6):
        assert store.append("log", spark.range(i, i + 1)) == 1
        assert len([p for p in (tmp_path / "log").iterdir()]) <= 4
    assert [r["id"] for r in store.read("log").orderBy("id").collect()] == list(range(6))


def test_write_tasks_and_buckets_grow_with_the_bytes(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        store = TableStore(spark, str(tmp_path), buckets=2)
        values = spark.range(0, 20_000, 1, 8).selectExpr("concat('E', id) AS EntryId", "'f' AS FlowId", "sha2(string(id), 256) AS StartId", "'t' AS StartTargetId")
        store.overwrite("Flow", values)
        assert len({p.parent for p in tmp_path.rglob("*.parquet")}) == 2
        assert len([*tmp_path.rglob("*.parquet")]) > 8  # many tasks for two buckets
        monkeypatch.setattr(store_module, "_BUCKET_BYTES", 200_000)
        store.upsert("Flow", values.limit(3), ["FlowId"])
        assert len({p.parent for p in tmp_path.rglob("*.parquet")}) > 4
        assert store.read("Flow").count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_a_small_batch_is_merged_without_a_shuffle_of_the_table(spark, tmp_path, monkeypatch):
    store, table = TableStore(spark, str(tmp_path)), TABLES["content"]
    order = ["class"]

    def rows(pairs):
        made = spark.createDataFrame(pairs, "id string, class string, name string, CodOnda string")
        return made.select(*[F.col(c) if c in made.columns else F.lit(None).cast("timestamp_ntz" if c.startswith("Dt") else "string").alias(c) for c in table.columns])

    old = rows([(f"M{i}", "1", "old", "684") for i in range(50)] + [(None, "1", "no id", "1")])
    store.upsert("content", old, order)
    batch = rows([("M3", "2", "new", "702"), ("M3", "1", "late", "653"), ("M99", "1", "fresh", "702"), (None, "1", "again", "2")])
    plans, merge = [], TableStore._merged

    def seen(self, *more):
        frame = merge(self, *more)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return frame

    monkeypatch.setattr(TableStore, "_merged", seen)
    expected = rows_of(upsert_table(store.read("content"), batch, table, order))
    store.upsert("content", batch, order)
    assert rows_of(store.read("content")) == expected
    assert "BroadcastHashJoin" in plans[0] and "hashpartitioning" not in plans[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.upsert("content", batch, order)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" in plans[1] and rows_of(store.read("content")) == expected


def test_documents_are_parsed_once_from_staging_to_adapter_objects(spark, tmp_path, monkeypatch):
    from assetlake.plans.derived import RUN_TS, WAVES, mapping_documents

    store = TableStore(spark, str(tmp_path))
    docs = mapping_documents(spark, "/root/testdata/sf0.001")
    member = F.struct("body", F.lit(None).cast("string").alias("error"))
    packages = docs.select("source_path", F.lit("a").alias("asset_name"), member.alias("maps"), member.alias("file_records"))
    plans, write = {}, TableStore._write

    def seen(self, name, rows, *more):
        plans.setdefault(name, []).append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write(self, name, rows, *more)

    monkeypatch.setattr(TableStore, "_write", seen)
    jobs.stage_packages(store, "stage_mappings", packages.repartition(2))
    jobs.load_content(store, jobs.staged(store, "maps")[0], RUN_TS)
    jobs.load_transformations(store, WAVES, RUN_TS)
    for kind in ("session", "advanced"):
        jobs.load_properties(store, kind, WAVES, RUN_TS)
    jobs.load_data_adapters(store, WAVES, RUN_TS)
    jobs.load_adapter_objects(store, WAVES, RUN_TS)
    assert plans["stage_mappings"][0].count("parse_json") + plans["stage_mappings"][0].count("parseJson") == 2  # one for each member
    later = [plan for name, made in plans.items() if name != "stage_mappings" for plan in made]
    assert len(later) >= 7
    assert not any("concat([" in plan or "parseJson(body" in plan or "parseJson(transformations" in plan for plan in later)
    assert store.read("transformation_data_adapter_object").count() > 100
    assert store.read("transformation").schema["session_properties"].dataType.typeName() == "string"
    assert store.read("transformation", "node").schema["session_properties"].dataType.typeName() == "variant"


def package_list(spark, first, last, stamp, more=()):
    """Rows of long texts with their place, and more rows of keys that come again or are NULL."""
    made = spark.range(first, last).selectExpr(
        "concat('g', id) AS id", "int(id % 9) AS CodOnda", "int(id) AS CodProcess", "sha2(string(id), 512) AS objectPath",
        f"'{stamp}' AS objectName", f"'{stamp}' AS objectType", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS Dt_Inserted",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS Dt_updated", "id AS place")
    again = [(*row[:2], 0, "p", stamp, stamp, None, None, row[2]) for row in more]
    return made.unionByName(spark.createDataFrame(again, ", ".join(f"{n} {t}" for n, t in made.dtypes)))


AGAIN = [("g7", 70, 10**6), ("g7", 71, -1), (None, 1, 5), (None, 2, 4), ("x", None, 3)]


@pytest.mark.parametrize("limit", [-1, 20_000, 10**9])
@pytest.mark.parametrize("more", [[], AGAIN])
def test_large_and_small_batches_give_the_rows_of_a_keyed_upsert(spark, tmp_path, monkeypatch, limit, more):
    monkeypatch.setattr(TableStore, "_broadcast_limit", lambda self: limit)
    store, name = TableStore(spark, str(tmp_path), buckets=2), "ContentsofExportPackage"
    table, order = TABLES[name], ["place"]
    expected = spark.createDataFrame([], table.schema)
    for first, last, stamp in [(0, 3000, "a"), (0, 3000, "b"), (1000, 4000, "c"), (5, 9, "d"), (0, 5000, "e")]:
        batch = package_list(spark, first, last, stamp, more)
        expected = spark.createDataFrame(upsert_table(expected, batch, table, order).collect(), table.schema)
        store.upsert(name, batch, order)
        assert rows_of(store.read(name)) == rows_of(expected)


def test_rows_are_written_once_where_no_key_repeats(spark, tmp_path, monkeypatch):
    name, order, plans, write = "transformation_session_properties", ["content_name", "_pos"], [], TableStore._write

    def seen(self, name, rows, *more):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, name, rows, *more)

    def rows(n):
        return spark.range(100).selectExpr(
            f"IF(id = 3, NULL, string(id % {n})) AS id", "'t' AS id_transf", "string(id) AS class", "'n' AS name", "'v' AS value",
            "'c' AS content_name", "IF(id % 4 = 0, '684', '702') AS CodOnda", "'1' AS CodProcess",
            "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id)) AS Dt_Inserted",
            "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS Dt_updated", "int(id) AS _pos")

    monkeypatch.setattr(TableStore, "_write", seen)
    store, table = TableStore(spark, str(tmp_path)), TABLES[name]
    store.replace_slices(name, rows(100), ["684", "702"], order)
    assert len(plans) == 1 and "Aggregate" not in plans[0] and "Exchange" not in plans[0]
    assert store.read(name).count() == 100 and store.read(name).columns == list(table.columns)
    assert store.replace_slices(name, rows(8), ["684", "702"], order) == 9
    expected = collapse_batch(rows(8), table.keys, table.insert_only, order, table.columns)
    assert rows_of(store.read(name)) == rows_of(expected)
    assert len({p.parents[1] for p in (tmp_path / name).rglob("*.parquet")}) == 1  # what was written before is gone
    monkeypatch.setattr(TableStore, "_broadcast_limit", lambda self: -1)
    store.upsert("Flow", flow_rows(spark, [(f"E{i}", "1") for i in range(40)]), ["FlowId"])
    assert len(plans) == 4 and "Exchange" not in plans[3]
