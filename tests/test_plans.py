"""The physical plans: pushed filters, map-side reduction, split hot keys, no row-wise Python."""

import pytest
from pyspark.sql import functions as F

from assetlake.operators.history import latest_batch
from assetlake.operators.merge import doomed_keys, upsert, without_keys
from assetlake.plans import document_queries
from assetlake.plans.catalog import QUERIES
from assetlake.operators.mappings import derive_transformations
from assetlake.plans.derived import mapping_documents, zipped
from assetlake.sources.scratch import stored

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_filter_is_pushed_to_the_scan(spark):
    plan = plan_of(QUERIES["current_batch"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-10" in plan and "LessThan(ts,2024-01-11" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_slice_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("CodOnda", (F.col("id") % 2).cast("string")).write.partitionBy(
        "CodOnda"
    ).parquet(path)
    table = spark.read.schema("id long, CodOnda string").parquet(path)
    assert "PartitionFilters: [CodOnda" in plan_of(table.filter(F.col("CodOnda").isin(["1"]))).replace(
        "isnotnull(CodOnda", "CodOnda"
    )


def test_upsert_reduces_before_its_only_shuffle_of_updates(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(100).selectExpr("id k", "string(id) v")
        updates = spark.range(100).selectExpr("id % 7 k", "string(id) v", "id o")
        plan = plan_of(upsert(target, updates, ["k"], ["o"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "partial_max_by" in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Window" not in plan


def test_hot_join_key_is_split(spark):
    """A third of all rows on one key: adaptive execution splits that partition."""
    small = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 200_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 'hot', string(id)) AS id", "sha2(string(id), 256) AS v"
        )
        doomed = doomed_keys(rows, F.col("id") < "3", "id")
        kept = without_keys(rows, doomed, "id")
        kept.collect()
        assert "skew=true" in plan_of(kept)
        tasks = rows.selectExpr("id AS name", "v", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS Dt_Updated")
        latest = latest_batch(tasks)
        latest.collect()
        assert "skew=true" in plan_of(latest)
    finally:
        for name in small:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "3")


@pytest.mark.parametrize("name", ["transformations", "session_properties", "adapter_objects",
                                  "task_parameters", "file_records", "connections"])
def test_documents_are_unnested_without_python_and_without_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "Python" not in plan and "InArrow" not in plan
    # Only the spreading of a source with fewer splits than cores.
    assert plan.count("Exchange") == plan.count("Exchange RoundRobinPartitioning") <= 1
    # The text of a document is parsed once.
    assert plan.count("parseJson(") == 1


def test_no_cross_join_in_any_query(spark):
    for name, run in QUERIES.items():
        if name.startswith("job_"):
            continue  # these run their jobs at once
        plan = plan_of(run(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_queries_keep_generated_methods_short_enough_to_be_compiled(spark):
    session = spark.newSession()
    QUERIES["transformations"](session, "/root/testdata/sf0.001")
    assert session.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_documents_are_built_by_compiled_code_and_lineage_builds_them_once(spark, monkeypatch):
    built = []
    monkeypatch.setattr(document_queries, "stored", lambda df, name: built.append(name) or stored(df, name))
    plan = plan_of(QUERIES["lineage"](spark, SF))
    assert "content" in built and "orders.parquet" not in plan
    assert "lambdafunction" not in plan_of(mapping_documents(spark, SF))


def test_elements_are_opened_in_one_pass_and_odd_ones_left_out(spark):
    items = '[1, null, "x", [], {}, {"$$ID": null}, {"$$ID": "T1", "name": null}, {"$$ID": 7, "fields": {"a": [1]}}]'
    content = spark.createDataFrame([("m", "c", "684", "1", items), ("n", "d", "684", "1", '{"$$ID": "T2", "name": "y"}'),
                                     ("o", "e", "684", "1", "3"), ("p", "f", None, None, None)],
                                    "id string, name string, CodOnda string, CodProcess string, transformations string")
    rows = derive_transformations(content, "2024-01-01 00:00:00").select("_content", "_pos", "id", "name", "fields")
    assert sorted(map(tuple, rows.collect())) == [
        ("m", 6, "T1", None, "[]"), ("m", 7, "7", "", '{"a":[1]}'), ("n", 0, "T2", "y", "[]")]
    # single keys are read of the root only, for the kind of the whole
    assert plan_of(rows).count("try_variant_get(") == 0


def test_newest_tasks_of_unique_names_need_no_join(spark):
    days = "IF(id % 3 = 0, TIMESTAMP_NTZ'2024-01-02 05:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:00') AS Dt_Updated"
    tasks = spark.range(30).selectExpr("IF(id = 6, NULL, string(id)) AS name", days)
    one, both = latest_batch(tasks, keys_unique=True), latest_batch(tasks)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, both.collect()))
    assert one.count() == 9 and "Join" not in plan_of(one) and "hashpartitioning" not in plan_of(one)


def test_packages_leave_python_in_small_batches(spark):
    given = {}

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            given["pack"] = function

    import pyarrow as pa

    zipped(Docs(), "m.json", ".zip")
    batch = pa.RecordBatch.from_pydict({"path": [str(i) for i in range(900)], "body": ["x"] * 899 + [None]})
    made = list(given["pack"](iter([batch, batch.slice(0, 0)])))
    assert [p for b in made for p in b.column("path").to_pylist()] == [str(i) for i in range(900)]
    assert max(b.num_rows for b in made) <= 250 and made[-2].column("content")[-1].as_py() == b""
