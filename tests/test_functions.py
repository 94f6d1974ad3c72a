"""Column helpers on literal inputs; expectations are worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assetlake import functions as L

MISSING = object()


def on_nodes(spark, helper, values):
    """Applies a helper to JSON texts; MISSING stands for an absent key."""
    rows = [(i, "{}" if v is MISSING else f'{{"v":{v}}}') for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "i int, j string").select(
        "i", L.member(F.try_parse_json("j"), "v").alias("v")
    )
    return [r[0] for r in frame.orderBy("i").select(helper(F.col("v"))).collect()]


def on_texts(spark, helper, values, extra=()):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] if len(r) == 1 else tuple(r) for r in
            frame.orderBy("i").select(*helper(F.col("t"))).collect()]


VALUES = [MISSING, "null", "true", "false", "0", "0.0", "7", "-2.5", "1.0", "2.50", '""', '"yes"',
          '" ON "', r'"\ttrue\n"', '"x"', "{}", "[]", '{"b": 1, "a": null}', "[1, 2]", '" [1]"']

CASES = {
    "flag01": (L.flag01, [0, 0, 1, 0, 0, 0, 1, 1, 1, 1, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0]),
    "flag_text": (L.flag_text, ["false", "false", "true", "false", "false", "false", "true", "true",
                                "true", "true", "false", "true", "true", "true", "false", "false",
                                "false", "false", "false", "false"]),
    "truthy": (L.truthy, [False, False, True, False, False, False, True, True, True, True, False,
                          True, True, True, True, False, False, True, True, True]),
    "title": (lambda v: L.value_to_string(v, "title"),
              ["", "", "True", "False", "0", "0.0", "7", "-2.5", "1.0", "2.5", "", "yes", " ON ",
               "\ttrue\n", "x", "{}", "[]", '{"a":null,"b":1}', "[1,2]", " [1]"]),
    "json": (L.value_to_string,
             ["", "", "true", "false", "0", "0.0", "7", "-2.5", "1.0", "2.5", "", "yes", " ON ",
              "\ttrue\n", "x", "{}", "[]", '{"a":null,"b":1}', "[1,2]", " [1]"]),
    "json_or_default": (lambda v: L.json_or_default(v, "[]"),
                        ["[]", "[]", "True", "False", "0", "0.0", "7", "-2.5", "1.0", "2.5", '""',
                         '"yes"', '" ON "', r'"\ttrue\n"', '"x"', "{}", "[]", '{"a":null,"b":1}',
                         "[1,2]", " [1]"]),
    "json_text": (lambda v: L.json_text(v, "{}"),
                  ["{}", "null", "true", "false", "0", "0", "7", "-2.5", "1", "2.5", '""', '"yes"',
                   '" ON "', r'"\ttrue\n"', '"x"', "{}", "[]", '{"a":null,"b":1}', "[1,2]",
                   '" [1]"']),
    "input_sorted": (L.input_sorted_text,
                     ["", "None", "true", "false", "0", "0.0", "7", "-2.5", "1.0", "2.5", "", "yes",
                      " ON ", "\ttrue\n", "x", "{}", "[]", '{"a":null,"b":1}', "[1,2]", " [1]"]),
    "is_true_literal": (L.is_true_literal, [False] * 20),
}


@pytest.mark.parametrize("name", CASES)
def test_node_helpers(spark, name):
    helper, expected = CASES[name]
    assert on_nodes(spark, helper, VALUES) == expected


def test_true_literal_and_class(spark):
    assert on_nodes(spark, L.is_true_literal, ['"true"', "true", '"TRUE"']) == [True, False, False]
    values = [MISSING, '"12"', "12", '"x"', '"1x"', "null", '"99999999999"']
    assert on_nodes(spark, L.class_int, values) == [0, 12, 12, 0, 0, None, 0]


def test_typed_keeps_missing_and_null_apart(spark):
    assert on_nodes(spark, lambda v: L.typed(v, default="d"), [MISSING, "null", "5", '""']) == [
        "d", None, "5", ""
    ]


def test_elements_of(spark):
    def sizes(values, **options):
        return on_nodes(spark, lambda v: F.size(L.elements_of(v, **options)), values)

    assert sizes(["[1,2]", '{"a":1}', "{}", "7", '"x"', "null", MISSING, "[]"]) == [
        2, 1, 1, None, None, None, None, 0
    ]
    wrapped = ['{"records":[1,2,3]}', '{"records":{"a":1}}', '{"other":1}',
               '{"@type":"k","records":[1,2]}']
    assert sizes(wrapped, inner_key="records", own_kind="k") == [3, None, 1, 1]


def test_codes(spark):
    names = ["a12_b345_6", "x", "", None]
    assert on_texts(spark, L.codes_by_digits, names) == [
        ("12", "345"), (None, None), (None, None), (None, None)
    ]
    assert on_texts(spark, L.codes_by_position, ["a_b_c_684_77_z", "a_b_c_684", "abc"]) == [
        ("684", "77"), ("684", None), (None, None)
    ]


def test_codes_by_type(spark):
    rows = [("tf_684_7", "TASKFLOW"), ("a_b_c_702_8", "MTT"), ("a_b_c_781_8", "MTT"),
            ("a_b_c_702_x", "MTT"), ("a_b_c_702", "DTEMPLATE"), ("a_b_c_702_", "MTT"), ("a", "MTT")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n string, t string")
    got = [tuple(r) for r in frame.orderBy("i").select(*L.codes_by_type(F.col("n"), F.col("t"))).collect()]
    assert got == [(684, 7), (702, 8), (0, 0), (0, 0), (702, 0), (702, 0), (0, 0)]


def test_ids_and_names(spark):
    assert on_texts(spark, lambda t: [L.strip_at(t)], ["@1", "@@1", "1", ""]) == ["1", "@1", "1", ""]
    assert on_texts(spark, lambda t: [L.federated_id(t)], ["x", "", None]) == ["saas:@x", "", None]
    paths = [r"C:\d\a.MTT.zip", "/x/y/b.MTT.zip", "c.MTT.zip"]
    assert on_texts(spark, lambda t: [L.asset_name(t, ".MTT.zip")], paths) == ["a", "b", "c"]


def moment(*parts):
    return dt.datetime(*parts)


def test_iso_times(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02 03:04:05", "2024-01-02T03:04:05.999",
             "2024-01-02", "20240102", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04-0330", "2024",
             "2024-13-01", " ", "", None, "never"]
    full = moment(2024, 1, 2, 3, 4, 5)
    expected = [full, full, full, moment(2024, 1, 2), moment(2024, 1, 2), moment(2024, 1, 2, 1, 4, 5),
                moment(2024, 1, 2, 6, 34), *[None] * 6]
    assert on_texts(spark, lambda t: [L.ts_from_iso(t)], texts) == expected
    wall = on_texts(spark, lambda t: [L.ts_from_iso(t, offset_rule="drop")], texts[5:6])
    assert wall == [full]
    default = on_texts(spark, lambda t: [L.brazil_time(L.ts_from_iso(t, "1990-01-01 00:00:00"))], [""])
    assert default == [moment(1989, 12, 31, 21)]


def test_xml_times(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02", "1900-01-01T00:00:00Z", "2024-01-02T03:04:05.1Z",
             "", None]
    assert on_texts(spark, lambda t: [L.ts_from_xml(t)], texts) == [
        moment(2024, 1, 2, 3, 4, 5), moment(2024, 1, 2), None, None, None, None
    ]


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert on_texts(spark, lambda t: [L.ts_from_iso(t)], ["2024-01-02T03:04:05Z"]) == [
            moment(2024, 1, 2, 3, 4, 5)
        ]
        millis = spark.range(1).select(L.ts_from_millis(F.lit(1704164645000))).first()[0]
        assert millis == moment(2024, 1, 2, 3, 4, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text(spark):
    assert on_texts(spark, lambda t: [L.text_or_empty(t)], [" \n a b\t", None, ""]) == ["a b", "", ""]
    assert L.clean_name("Cod. Onda (x)") == "Cod_Onda_x"


def test_adapters_are_counted_without_reading_them(spark):
    """The id of an adapter, or of the first in an array, is looked up by its path alone."""
    from assetlake.plans.jobs import _has_adapter

    given = {
        '{"$$ID":"A"}': True, '{"$$ID":""}': True, '{"$$ID":0}': True, '{"$$ID":{}}': True, '{"$$ID":null}': False, "{}": False,
        '[{"$$ID":"A"}]': True, '[{"x":1},{"$$ID":"A"}]': False, '[{"$$ID":null}]': False, "[]": False, '[["$$ID"]]': False,
        '"$$ID"': False, "1": False, "null": False, "no json": False,
    }
    rows = spark.createDataFrame([(text,) for text in given], "text string")
    rows = rows.withColumn("data_adapter", F.try_parse_json("text")).withColumn("found", _has_adapter())
    assert {r["text"]: r["found"] for r in rows.select("text", "found").collect()} == given
    assert "array<variant>" not in rows._jdf.queryExecution().analyzed().toString()


def test_truthy_makes_json_text_of_doubtful_values_only(spark):
    given = {
        '"x"': True, '""': False, '"false"': True, "false": False, "true": True, '"{}"': True, "{}": False, '"[]"': True, "[]": False,
        '"0"': True, "0": False, "-0.0": False, "0.00": False, "0e3": False, "1e3": True, '"E5"': True, '"null"': True, "null": False,
        "[0]": True, '{"a":null}': True, '"false\\n"': True, '"-"': True, '"."': True,
    }
    rows = spark.createDataFrame([(text,) for text in given], "text string")
    found = rows.select("text", L.truthy(F.try_parse_json("text")).alias("found"))
    assert {r["text"]: r["found"] for r in found.collect()} == given
    assert "to_json" not in str(L.truthy(F.col("v"))).lower().split("then")[0]
