"""Table maintenance against a plain dictionary model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import rows_of

from pyspark.sql import functions as F

from assetlake.operators.merge import (
    cascade_delete,
    insert_ignore,
    latest_per_key,
    replace_slice,
    upsert,
)

SCHEMA = "k int, part string, first string, v string"
KEYS, FIRST = ["k", "part"], ["first"]
keys = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["a", "b"]))
values = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))
batches = st.lists(st.tuples(keys, values, values), max_size=12)


def frame(spark, rows, ordered=False):
    data = [(k, p, f, v, i) for i, ((k, p), f, v) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA + ", o int")
    return df if ordered else df.drop("o")


def model(target, batch):
    table = {k: (f, v) for k, f, v in target}
    for k, f, v in batch:
        table[k] = (table[k][0] if k in table else f, v)
    return sorted(((*k, *row) for k, row in table.items()), key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=batches, batch=batches)
def test_upsert_follows_the_model(spark, target, batch):
    target = list({k: (k, f, v) for k, f, v in target}.values())
    result = upsert(frame(spark, target), frame(spark, batch, True), KEYS, ["o"], FIRST)
    assert rows_of(result) == model(target, batch)


def test_upsert_twice_changes_nothing(spark):
    target = frame(spark, [((1, "a"), "f", "v")])
    batch = frame(spark, [((1, "a"), "g", "w"), ((None, "a"), "g", None)], True)
    once = upsert(target, batch, KEYS, ["o"], FIRST)
    assert rows_of(upsert(once, batch, KEYS, ["o"], FIRST)) == rows_of(once)


def test_order_of_partitions_does_not_matter(spark):
    batch = frame(spark, [((1, "a"), str(i), str(i)) for i in range(50)], True)
    for n in (1, 7):
        got = upsert(frame(spark, []), batch.repartition(n, "v"), KEYS, ["o"], FIRST)
        assert rows_of(got) == [(1, "a", "0", "49")]


def test_latest_row_keeps_its_nulls(spark):
    df = frame(spark, [((1, "a"), "x", "y"), ((1, "a"), None, None)], True)
    assert rows_of(latest_per_key(df, KEYS, ["o"])) == [(1, "a", None, None, 1)]


def test_insert_ignore_takes_the_first(spark):
    target = frame(spark, [((1, "a"), "old", "old")])
    batch = frame(spark, [((1, "a"), "n", "n"), ((2, "a"), "n", "1"), ((2, "a"), "n", "2"),
                          ((None, "a"), "n", "3")], True)
    once = insert_ignore(target, batch, KEYS, ["o"])
    expected = [(1, "a", "old", "old"), (2, "a", "n", "1"), (None, "a", "n", "3")]
    assert rows_of(once) == sorted(expected, key=repr)
    assert rows_of(insert_ignore(once, batch, KEYS, ["o"])) == rows_of(once)


def test_slice_and_rest_make_the_whole(spark):
    table = frame(spark, [((i, "ab"[i % 2]), "f", "v") for i in range(6)])
    same = replace_slice(table, table.filter("part = 'a'"), "part", ["a"])
    assert rows_of(same) == rows_of(table)
    assert rows_of(replace_slice(table, table.limit(0), "part", ["a", "b"])) == []
    nulls = spark.createDataFrame([(None, 1)], "part string, x int")
    assert replace_slice(nulls, nulls.limit(0), "part", ["a"]).count() == 1


def test_cascade_keeps_rows_without_key(spark):
    parent = spark.createDataFrame([("e1", "tf__684_x"), ("e2", "tf__702_x")], "id string, n string")
    child = spark.createDataFrame([(1, "e1"), (2, "e2"), (3, None)], "c int, id string")
    out = cascade_delete({"p": parent, "c": child}, "p", F.col("n").like("____684%"), "id")
    assert rows_of(out["p"]) == [("e2", "tf__702_x")]
    assert rows_of(out["c"]) == [(2, "e2"), (3, None)]


def test_upsert_leaves_the_files_of_untouched_buckets(spark, tmp_path):
    from assetlake.schemas import TABLES
    from assetlake.sources.store import TableStore

    store, table = TableStore(spark, str(tmp_path)), TABLES["Flow"]
    rows = [(f"E{i}", "f", "s", str(i)) for i in range(60)]
    store.upsert("Flow", spark.createDataFrame(rows, table.schema), ["FlowId"])

    def files():
        return {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.parquet")}

    before = files()
    store.upsert("Flow", spark.createDataFrame([("E7", "g", "s", "new"), ("E99", "g", "s", "x")], table.schema), ["FlowId"])
    after = files()
    assert len(before) > 8 and len(before - after) in (1, 2) and len(after - before) in (1, 2)
    kept = {r["EntryId"]: r["StartTargetId"] for r in store.read("Flow").collect()}
    assert kept == {f"E{i}": str(i) for i in range(60)} | {"E7": "new", "E99": "x"}
    everything = store.read("Flow").select("EntryId")
    assert store.rewrite("Flow", everything, lambda old: old.filter("EntryId = 'E1'")) == 1
    assert [r["EntryId"] for r in store.read("Flow").collect()] == ["E1"]
