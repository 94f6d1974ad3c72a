"""Lineage on small tables."""

from conftest import rows_of

from assetlake.operators.lineage import lineage


def test_copies_of_a_document_do_not_multiply_rows(spark):
    codes = "CodOnda string, CodProcess string"
    objects = spark.createDataFrame(
        [("o1", "a1", "t1", "tab", "/p", "684", "7"), ("o2", "a9", "t1", "x", "/p", "684", "7")],
        f"id string, id_data_adapter string, id_transf string, object_name string, path string, {codes}",
    )
    adapters = spark.createDataFrame(
        [("a1", "t1", "c9", "T", "684", "7")],
        f"id string, id_transf string, connection_id string, object_type string, {codes}",
    )
    transformations = spark.createDataFrame(
        [("t1", "src_a", "map", "684", "7"), ("t1", "src_a", "map", "702", "7")],
        f"id string, name string, content_name string, {codes}",
    )
    content = spark.createDataFrame(
        [("m1", "map", "684", "7"), ("m2", "map", "684", "7"), ("m3", "map", "702", "7")],
        f"id string, name string, {codes}",
    )
    connections = spark.createDataFrame([("c1", "db", "Oracle")], "id string, name string, type string")
    got = lineage(objects, adapters, transformations, content, connections)
    assert rows_of(got, "object_id", "content_id", "connection_id", "connection_name") == [
        ("o1", "m2", "c9", None), ("o2", "m2", None, None)
    ]


def test_objects_without_codes_or_parents_stay(spark):
    codes = "CodOnda string, CodProcess string"
    none = (None, None)
    objects = spark.createDataFrame(
        [("o1", "a1", "t1", "tab", "/p", *none), ("o2", "gone", "t1", "x", "/p", *none)],
        f"id string, id_data_adapter string, id_transf string, object_name string, path string, {codes}",
    )
    adapters = spark.createDataFrame(
        [("a1", "t1", "c1", "T", *none)],
        f"id string, id_transf string, connection_id string, object_type string, {codes}",
    )
    transformations = spark.createDataFrame(
        [("t1", "src_a", "map", *none)], f"id string, name string, content_name string, {codes}"
    )
    content = spark.createDataFrame([("m1", "map", *none)], f"id string, name string, {codes}")
    connections = spark.createDataFrame([("c1", "db", "Oracle")], "id string, name string, type string")
    got = lineage(objects, adapters, transformations, content, connections)
    assert rows_of(got, "object_id", "adapter_type", "content_id", "connection_name") == [
        ("o1", "T", "m1", "db"), ("o2", None, "m1", None)
    ]
