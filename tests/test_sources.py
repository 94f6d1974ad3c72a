"""Scans of real files: archives, JSON, CSV, XML, sheets, project paths, streams."""

import zipfile

from conftest import mapping, rows_of, write_zip

from assetlake.operators.mappings import derive_content
from assetlake.operators.standardize import apply_rename_rules, clean_columns
from assetlake.operators.taskflows import TASKFLOW_ORDER, shred_taskflows
from assetlake.operators.merge import upsert_table
from assetlake.plans import jobs
from assetlake.schemas import TABLES
from assetlake.sources import archives, documents
from assetlake.sources.documents import scan_json_documents, scan_package_csv
from assetlake.sources.files import binary_files
from assetlake.sources.paths import asset_paths, project_folders, with_path_columns
from assetlake.sources.sheets import scan_sheet, sheet_frame
from assetlake.sources.store import TableStore
from assetlake.sources.taskflow_xml import NAMESPACES, scan_taskflow_xml
from assetlake.streaming.arrivals import load_arrivals, stream_archives

import pytest
from pyspark.sql import functions as F


def test_archives(spark, tmp_path):
    write_zip(tmp_path / "a.MTT.zip", {"x/y_mtTask.json": "one", "mtTask.json": "two"})
    write_zip(tmp_path / "b.MTT.zip", {"other": "1"})
    (tmp_path / "c.MTT.zip").write_bytes(b"junk")
    with zipfile.ZipFile(tmp_path / "d.MTT.zip", "w") as z:
        z.writestr("mtTask.json", b"\xff\xfe")
    write_zip(tmp_path / "e.DTEMPLATE.zip", {"mtTask.json": "not of this kind"})
    got = archives.scan_archives(spark, str(tmp_path), *archives.TASKS)
    assert rows_of(got, "asset_name", "body", "error") == [
        ("a", "one", None), ("b", None, "member not found"), ("c", None, "corrupt archive"),
        ("d", None, "member is not UTF-8 text"),
    ]


def test_large_and_unicode_members_come_whole(spark, tmp_path):
    body = "é\n" * 3_000_000
    for i in range(4):
        write_zip(tmp_path / f"{i}.MTT.zip", {"mtTask.json": body + str(i)})
    got = archives.scan_archives(spark, str(tmp_path), *archives.TASKS)
    assert sorted(len(r["body"]) for r in got.collect()) == [6_000_001] * 4


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1,\n "x": 2}')
    (tmp_path / "b.json").write_text("{bad")
    (tmp_path / "c.txt").write_text("{}")
    (tmp_path / "d.json").write_text('{"x": 1} trailing')
    (tmp_path / "e.json").write_text('{"x": 1}, {"x": 2}')
    (tmp_path / "f.json").write_text(" \n")
    got = scan_json_documents(spark, str(tmp_path))
    errors = {r["source_path"].rsplit("/", 1)[-1]: r["error"] for r in got.collect()}
    bad = "not a JSON document"
    assert errors == {"a.json": None, **dict.fromkeys(["b.json", "d.json", "e.json", "f.json"], bad)}
    last = got.filter("error IS NULL").select(F.try_variant_get(F.parse_json("body"), "$.x", "int"))
    assert last.first()[0] == 2


def test_csv(spark, tmp_path):
    (tmp_path / "l.csv").write_text(
        'id,objectPath,objectName,objectType\n1,"/a, ""q""\nb",n,MTT\n2,short\n', encoding="utf-8"
    )
    got = scan_package_csv(spark, str(tmp_path))
    assert rows_of(got, "id", "objectPath", "objectType") == [
        ("1", '/a, "q"\nb', "MTT"), ("2", "short", None)
    ]
    assert rows_of(got.filter("error IS NOT NULL"), "id", "error") == [("2", "2,short")]


def test_every_list_has_its_own_header_and_keeps_its_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,objectPath,objectName,objectType\n1,/a,n,MTT\n1,/b,NA,DTEMPLATE\n")
    (tmp_path / "b.csv").write_text("objectType,more,id\nMTT,x,2\n")
    (tmp_path / "c.csv").write_text("")
    got = scan_package_csv(spark, str(tmp_path))
    assert rows_of(got, "id", "_pos", "objectPath", "objectName", "objectType", "error") == [
        ("1", 0, "/a", "n", "MTT", None), ("1", 1, "/b", None, "DTEMPLATE", None),
        ("2", 0, None, None, "MTT", None),
    ]
    store = TableStore(spark, str(tmp_path / "tables"))
    jobs.load_package_contents(store, got, "2024-01-01 00:00:00")
    kept = store.read("ContentsofExportPackage")
    assert rows_of(kept, "id", "objectType", "objectPath")[0][:2] == ("1", "MTT")


def test_a_bad_byte_or_a_long_field_loses_one_row_at_most(spark, tmp_path):
    head, long = b"id,objectPath,objectName,objectType\n", b"x" * 200_000
    (tmp_path / "a.csv").write_bytes(head + b"1,/a,n,MTT\n2,\xff,n,MTT\n3,/c,n,MTT\n4," + long + b",n,MTT\n5,/e\n6,/f,n,MTT\n")
    (tmp_path / "b.csv").write_bytes(head + b'7,"/g\n""h""",n,MTT\n8,\xff,n,MTT\n9,"' + long + b'",n,MTT\n')
    got = scan_package_csv(spark, str(tmp_path))
    assert sorted(r["id"] for r in got.where("error is null").collect()) == ["1", "3", "4", "6", "7", "9"]
    assert sorted(r["id"] for r in got.where("error is not null").collect()) == ["2", "5", "8"]
    assert {len(r["objectPath"]) for r in got.where("id in ('4', '9')").collect()} == {200_000}
    assert rows_of(got, "id", "_pos") == [(str(i), i - 1) for i in range(1, 7)] + [("7", 0), ("8", 1), ("9", 2)]


def test_a_large_list_is_split_and_keeps_its_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,objectPath\n" + "".join(f"{i % 77},/p{i}\n" for i in range(5000)))
    (tmp_path / "b.csv").write_text("\ufeffobjectPath,id,id\n" + "".join(f"/q{i},no,{i}\n" for i in range(10)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10KB")
    try:
        got = scan_package_csv(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    first = sorted((r for r in got if r["source_path"].endswith("a.csv")), key=lambda r: r["_pos"])
    assert [(r["_pos"], r["id"], r["objectPath"]) for r in first] == [(i, str(i % 77), f"/p{i}") for i in range(5000)]
    second = sorted((r for r in got if r["source_path"].endswith("b.csv")), key=lambda r: r["_pos"])
    assert [(r["_pos"], r["id"], r["objectPath"]) for r in second] == [(i, str(i), f"/q{i}") for i in range(10)]


def test_workbooks_with_columns_in_another_order(spark):
    cells = spark.createDataFrame(
        [("x", 0, 0, "A"), ("x", 0, 1, "B"), ("x", 1, 0, "a1"), ("x", 1, 1, "NA"),
         ("y", 0, 0, "B"), ("y", 0, 1, "A"), ("y", 1, 0, "b2"), ("y", 1, 1, "a2")],
        "source_path string, row int, col int, value string",
    ).withColumn("error", F.lit(None).cast("string"))
    assert rows_of(sheet_frame(cells), "source_path", "A", "B") == [("x", "a1", None), ("y", "a2", "b2")]


def test_a_file_too_large_for_a_row_is_opened_by_its_path(spark, tmp_path):
    write_zip(tmp_path / "a.MTT.zip", {"mtTask.json": "{}"})
    files = spark.createDataFrame([(f"file:{tmp_path}/a.MTT.zip", None)], "path string, content binary")
    got = archives.unzip_members(files, *archives.TASKS)
    assert rows_of(got, "asset_name", "body", "error") == [("a", "{}", None)]


def test_paths(spark, tmp_path):
    (tmp_path / "684_alpha" / "Explore" / "684_alpha" / "Fatos").mkdir(parents=True)
    (tmp_path / "684_alpha" / "SYS").mkdir()
    projects = spark.createDataFrame([(684, "alpha"), (1, "none")], "cod_projeto int, nme_projeto string")
    folders = spark.createDataFrame(
        [(684, "Fatos"), (684, "Fatos"), (684, "Gone")], "cod_projeto int, pasta string"
    )
    of_run = project_folders(projects, folders, [684, 1])
    assert rows_of(of_run, "project_label", "pasta") == [("684_alpha", "Fatos"), ("684_alpha", "Gone")]
    assert project_folders(projects, folders, with_folder=False).count() == 1
    assert asset_paths(spark, str(tmp_path), of_run) == [f"{tmp_path}/684_alpha/Explore/684_alpha/Fatos"]
    assert asset_paths(spark, str(tmp_path), of_run, "SYS") == [f"{tmp_path}/684_alpha/SYS"]
    paths = spark.createDataFrame(
        [("/b/684_alpha/Explore/684_alpha/Fatos/x.zip",), ("/b/684_alpha/SYS/c.zip",),
         ("/b/684_alpha/l.csv",)], "source_path string")
    assert rows_of(with_path_columns(paths), "project_label", "CodOnda", "folder") == [
        ("684_alpha", "684", "684_alpha"), ("684_alpha", "684", "Fatos"), ("684_alpha", "684", "SYS")
    ]


def flow_xml(*items):
    spaces = " ".join(f'xmlns:{k}="{v}"' for k, v in NAMESPACES.items())
    return f'<?xml version="1.0" encoding="ISO-8859-1"?><r {spaces}>{"".join(items)}</r>'


def test_taskflow_files(spark, tmp_path):
    item = ('<types1:Item><types1:EntryId>E1</types1:EntryId><types1:Name>é{n}</types1:Name>'
            '<types1:CreationDate>2024-01-02T03:04:05.5Z</types1:CreationDate></types1:Item>')
    (tmp_path / "a.xml").write_bytes(flow_xml(item.format(n=1), item.format(n=2)).encode("latin-1"))
    (tmp_path / "b.xml").write_bytes(flow_xml(item.format(n=3)).encode("latin-1"))
    (tmp_path / "c.xml").write_text("<broken")
    (tmp_path / "d.xml").write_text(flow_xml())
    items = scan_taskflow_xml(spark, str(tmp_path))
    assert [r["source_path"][-5:] for r in items.filter("error IS NOT NULL").collect()] == ["c.xml"]
    rows = shred_taskflows(items)["Item"]
    assert rows_of(rows, "Name", "CreationDate", "Tags") == [
        ("é1", None, ""), ("é2", None, ""), ("é3", None, "")
    ]
    empty = spark.createDataFrame([], TABLES["Item"].schema)
    merged = upsert_table(empty, rows, TABLES["Item"], TASKFLOW_ORDER)
    assert rows_of(merged, "EntryId", "Name") == [("E1", "é3")]


def test_a_large_taskflow_file_is_split_and_keeps_its_order(spark, tmp_path):
    item = ('<types1:Item><types1:EntryId>E{n}</types1:EntryId><types1:Name>é &lt;{n}&gt;</types1:Name><types1:Entry>'
            '<ns0:taskflow name="a&gt;b" x=\'1>2\'><ns0:flow><ns0:eventContainer><ns0:service id="s"><ns0:serviceInput>'
            '<ns0:parameter name="p">\n  <ns0:operation source="o"> </ns0:operation>tail</ns0:parameter>'
            '<ns0:parameter name="q" source="a>b">in <ns0:operation/>tail</ns0:parameter></ns0:serviceInput></ns0:service>'
            '</ns0:eventContainer></ns0:flow></ns0:taskflow></types1:Entry></types1:Item>\n')
    items = [item.format(n=n % 90) for n in range(300)] + ["<types1:Item/>", "<!-- none -->"]
    (tmp_path / "a.xml").write_bytes(flow_xml(*items).encode("latin-1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        found = scan_taskflow_xml(spark, str(tmp_path))
        plan = found._jdf.queryExecution().toString()
        assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r["pos"]["block"] for r in rows}) > 3
    ordered = sorted(rows, key=lambda r: (r["pos"]["block"], r["pos"]["row"]))
    assert [r["item"]["Name"] for r in ordered] == [f"é <{n % 90}>" for n in range(300)]
    shredded = shred_taskflows(found)
    values = rows_of(shredded["ServiceInput"].distinct(), "ParameterName", "Source", "Value")
    assert set(values) == {("p", "", "\n  "), ("q", "a>b", "in ")}
    assert set(rows_of(shredded["ServiceOperation"], "OperationSource", "Value")) == {("o", " "), ("", "")}


def test_taskflow_files_with_other_prefixes_and_encodings(spark, tmp_path):
    item = "<types1:Item><types1:EntryId>{n}</types1:EntryId><types1:Name>é</types1:Name></types1:Item>"
    uri = NAMESPACES["types1"]

    def put(name, text, encoding="latin-1"):
        (tmp_path / f"{name}.xml").write_bytes(text.encode(encoding))

    put("a", flow_xml(item.format(n="a")))
    put("b", flow_xml(item.format(n="b")).replace("types1", "q"))
    put("c", flow_xml(item.format(n="c").replace("types1:", "")).replace("xmlns:types1", "xmlns"))
    put("d", "\ufeff" + flow_xml(item.format(n="d")).replace("ISO-8859-1", "UTF-8"), "utf-8")
    put("bad1", flow_xml(item.format(n="x")).replace("ISO-8859-1", "utf-8"))
    put("bad2", flow_xml(item.format(n="x")).replace("ISO-8859-1", "koi8-r"))
    put("bad3", flow_xml(item.format(n="x"), "<open>"))
    put("bad4", flow_xml(item.format(n="x"))[:-5])
    put("bad5", flow_xml(item.format(n="x"), "<types1:Item><types1:Name></types1:Item>"))
    put("none", f'<r xmlns="{uri}"/>')
    got = scan_taskflow_xml(spark, str(tmp_path))
    good = got.where("error is null").select("item.EntryId", "item.Name").collect()
    assert sorted(tuple(r) for r in good) == [(n, "é") for n in "abcd"]
    bad = {r["source_path"].rsplit("/", 1)[-1][:-4]: r["error"] for r in got.where("error is not null").collect()}
    assert set(bad) == {"bad1", "bad2", "bad3", "bad4", "bad5"} and "koi8-r" in bad["bad2"]


def workbook(path, sheet, shared=(), styles=""):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    strings = "".join(f"<si><t>{t}</t></si>" for t in shared)
    write_zip(path, {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="z" r:id="r2"/>'
                           f'<sheet name="a" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/other.xml"/>'
                                      '<Relationship Id="r2" Target="worksheets/first.xml"/></Relationships>',
        "xl/worksheets/first.xml": f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>",
        "xl/sharedStrings.xml": f"<sst {main}>{strings}</sst>",
        "xl/styles.xml": f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
    })


def test_sheet(spark, tmp_path):
    path = tmp_path / "s.xlsx"
    workbook(
        path,
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>1</v></c></row>'
        '<row r="2"><c r="A2"><v>1.5</v></c><c r="C2" t="inlineStr"><is><t>x</t></is></c>'
        '<c r="D2" s="1"><v>45292</v></c></row><row r="4"><c r="B4" t="e"><v>#N/A</v></c>'
        '<c r="A4" t="s"><v>2</v></c></row>',
        shared=["Cod. (x)", "UME_TRAFEGO", "abc"],
    )
    sheet = scan_sheet(spark, str(path))
    assert sheet.columns == ["Cod. (x)", "UME_TRAFEGO", "Unnamed: 2", "UME_TRAFEGO.1"]
    clean = clean_columns(sheet)
    assert clean.columns == ["Cod_x", "UME_TRAFEGO", "Unnamed:_2", "UME_TRAFEGO1"]
    assert rows_of(clean) == [("1.5", None, "x", "2024-01-01 00:00:00"), ("abc", None, None, None)]


def test_rename_rules(spark):
    frame = spark.createDataFrame([(1, 2)], ["TCOGER", "other"])
    with pytest.warns(UserWarning, match="UME_TRAFEGO"):
        assert apply_rename_rules(frame, "684").columns == ["DSSGER", "other"]
    with pytest.raises(ValueError, match="GRW"):
        apply_rename_rules(frame, "702")
    assert apply_rename_rules(frame, "111").columns == frame.columns


def test_content_edge_cases(spark):
    bodies = ['{"content":{"$$IID":"a"}}', '{"content":null}', "[]", '{"content":{"$$IID":0}}',
              '{"content":{"$$IID":5,"name":null,"annotations":null}}', "oops"]
    docs = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "source_path string, body string")
    got = derive_content(docs, "2024-01-01 00:00:00")
    assert rows_of(got, "id", "name", "annotations", "transformations", "CodOnda") == [
        ("5", None, "null", "[]", None), ("a", "", "{}", "[]", None)
    ]


def test_stream_of_arrivals(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    packages, checkpoint = tmp_path / "in", str(tmp_path / "check")

    def arrive(day):
        docs = stream_archives(spark, str(packages), *archives.MAPPINGS)
        load_arrivals(
            docs, lambda d: jobs.load_content(store, d, day),
            lambda d: store.append("rejects", d), checkpoint,
        ).awaitTermination()
        return rows_of(store.read("content"), "id", "name", "Dt_Inserted")

    write_zip(packages / "a.DTEMPLATE.zip", {"@3.bin": mapping("M1", "one", [])})
    (packages / "bad.DTEMPLATE.zip").write_bytes(b"x")
    first = arrive("2024-01-01 00:00:00")
    assert [r[:2] for r in first] == [("M1", "one")]
    write_zip(packages / "b.DTEMPLATE.zip", {"@3.bin": mapping("M1", "two", [])})
    write_zip(packages / "c.DTEMPLATE.zip", {"@3.bin": mapping("M2", "new", [])})
    second = arrive("2024-01-02 00:00:00")
    assert [r[:2] for r in second] == [("M1", "two"), ("M2", "new")]
    assert second[0][2] == first[0][2]
    assert arrive("2024-01-03 00:00:00") == second
    assert rows_of(store.read("rejects"), "asset_name", "error") == [("bad", "corrupt archive")]


def test_staged_json_errors(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    packages = spark.createDataFrame(
        [("p1", "p1", ('{"a": 1}', None)), ("p2", "p2", ("{", None)), ("p3", "p3", (None, "corrupt archive"))],
        "source_path string, asset_name string, tasks struct<body: string, error: string>",
    )
    assert jobs.stage_packages(store, "stage_tasks", packages) == {"stage_tasks": 3}
    good, bad = jobs.staged(store, "tasks")
    assert rows_of(good, "source_path") == [("p1",)]
    assert rows_of(bad, "source_path", "error") == [("p2", "not a JSON document"), ("p3", "corrupt archive")]


def test_a_package_gives_all_its_members_at_once(spark, tmp_path):
    write_zip(tmp_path / "a.DTEMPLATE.zip", {"1@3.bin": "map", "fileRecord.json": "records"})
    write_zip(tmp_path / "b.DTEMPLATE.zip", {"1@3.bin": "only"})
    members = {"maps": "@3.bin", "file_records": "fileRecord.json"}
    got = archives.scan_packages(spark, str(tmp_path), ".DTEMPLATE.zip", members)
    assert rows_of(got, "asset_name", "maps.body", "file_records.body", "file_records.error") == [
        ("a", "map", "records", None), ("b", "only", None, "member not found")
    ]


def test_folders_are_listed_and_files_read_in_tasks(spark, tmp_path):
    """The plan of a scan knows no file names, yet finds the files that Spark's own scan finds."""
    names = ["a b.json", "c%20d.json", "x#y.json", "k=1,[é.json", "_hidden.json", ".h.json", "other.txt"]
    for name in names:
        (tmp_path / name).write_text("{}")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "bytes.json").write_bytes(b"\xff{}")
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "z.json").write_text("{}")
    got = scan_json_documents(spark, str(tmp_path))
    assert not [f for f in got.inputFiles() if f.endswith(".json")]
    by_spark = spark.read.text(str(tmp_path), wholetext=True, pathGlobFilter="*.json")
    by_spark = by_spark.selectExpr("_metadata.file_path", "hex(value)")
    assert rows_of(got.selectExpr("source_path", "hex(body)")) == rows_of(by_spark)
    files = binary_files(spark, str(tmp_path), "*.json")
    assert not [f for f in files.inputFiles() if f.endswith(".json")]
    by_spark = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(str(tmp_path))
    assert rows_of(files.selectExpr("path", "hex(content)")) == rows_of(by_spark.selectExpr("path", "hex(content)"))


def test_a_pattern_is_left_to_sparks_scan(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text("{}")
    assert scan_json_documents(spark, f"{tmp_path}/*").count() == 1


def test_lists_are_read_without_listing_what_lies_below(spark, tmp_path, monkeypatch):
    (tmp_path / "l.csv").write_text("id,objectPath,objectName,objectType\n1,/a,n,MTT\n")
    (tmp_path / "Explore").mkdir()
    asked = []
    read = documents._list_files
    monkeypatch.setattr(documents, "_list_files", lambda spark, paths: asked.append(paths) or read(spark, paths))
    assert rows_of(scan_package_csv(spark, [str(tmp_path)]), "id", "objectName") == [("1", "n")]
    assert asked == [[f"file:{tmp_path}/l.csv"]]


def test_packages_are_packed_by_all_tasks_and_lie_in_many_folders(spark):
    """A table in one partition is packed by many tasks; each path is written by one of them."""
    from assetlake.plans.catalog import QUERIES  # registers the checks that the scan queries use
    from assetlake.plans.scan_queries import _scanned_packages, _spread_packages

    rows = spark.range(40).coalesce(1).selectExpr("concat('a', id) AS source_path", "concat('text ', id) AS body")
    rows = rows.union(rows.where("source_path = 'a7'")).coalesce(1)
    packages = _spread_packages(rows, "x/mtTask.json", ".MTT.zip", 5)
    task = F.spark_partition_id()
    assert packages.select(task).distinct().count() > 1
    assert packages.select("path", task.alias("task")).distinct().groupBy("path").count().where("count > 1").isEmpty()
    assert packages.select(F.substring_index("path", "/", 1)).distinct().count() == 5
    assert _spread_packages(rows, "x/mtTask.json", ".MTT.zip", 100).rdd.getNumPartitions() == 100
    found = _scanned_packages(spark, packages, 5, "packages", ".MTT.zip", "mtTask.json")
    assert {(r["asset_name"], r["body"], r["error"]) for r in found.collect()} == {(f"a{i}", f"text {i}", None) for i in range(40)}
    assert found.count() == 40 and "scan_tasks" in QUERIES
