"""Asset documents built by Spark from the relational test tables.

Every order becomes a mapping document and every line item a task document, with all the
shapes the operators must cope with chosen by the row's numbers; the number of documents
grows with the tables.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import dealt, spread, table

RUN_TS = "2024-06-01 12:30:00"

# SQL text that reads the same in Spark and in the checking database.
WAVES = ["653", "673", "674", "684", "702", "781", "999"]


def wave_sql(number: str) -> str:
    """Wave code chosen by a number."""
    cases = " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(WAVES))
    return f"(CASE ({number}) % {len(WAVES)} {cases} END)"


ORDER_WAVE = wave_sql("o_custkey")
CONTENT_NAME = (
    f"(CASE WHEN o_orderkey % 41 = 0 THEN '' WHEN o_orderkey % 41 = 1 THEN 'm_ld' "
    f"ELSE concat('m_ld_x_', {ORDER_WAVE}, '_', CAST(o_custkey % 100 AS varchar(20)), '_k', "
    f"CAST(o_orderkey AS varchar(20))) END)"
)


# JSON text of the nested parts, as templates of t and i, the places in the arrays of transformations
# and properties.  Each place is written out: the lambda of an array function is not compiled.
def _property_json(kind: str) -> str:
    return f"""concat('{{"$$class":"c', i, '"',
        CASE (o_orderkey + t + i) % 13 WHEN 0 THEN '' WHEN 1 THEN ',"$$ID":""'
          ELSE concat(',"$$ID":"{kind}', o_orderkey, '_', t, '_', i, '"') END,
        CASE (o_orderkey + i) % 5 WHEN 0 THEN '' WHEN 1 THEN ',"name":""'
          ELSE concat(',"name":"p', o_custkey % 10, '"') END,
        CASE (o_orderkey + t + i) % 9
          WHEN 0 THEN ',"value":true' WHEN 1 THEN ',"value":false' WHEN 2 THEN ',"value":null'
          WHEN 3 THEN concat(',"value":', o_custkey) WHEN 4 THEN ',"value":2.50'
          WHEN 5 THEN ',"value":{{"b":[1,2],"a":"x"}}' WHEN 6 THEN ',"value":[1,"z"]'
          WHEN 7 THEN '' ELSE concat(',"value":"', o_orderpriority, '"') END, '}}')"""


def _at(template: str, **places: int) -> str:
    """A template at one place."""
    for name, place in places.items():
        template = re.sub(rf"\b{name}\b", str(place), template)
    return template


def _properties_json(kind: str, wrapper: str) -> str:
    """The properties of a transformation, from columns of their own (see ``_properties``)."""
    one, both = f"concat_ws(',', _{kind}_t_0)", f"concat_ws(',', _{kind}_t_0, _{kind}_t_1)"
    return f"""CASE (o_orderkey + t) % 4
        WHEN 0 THEN concat(',"{wrapper}":[', {both}, ']')
        WHEN 1 THEN concat(',"{wrapper}":', {one})
        WHEN 2 THEN concat(',"{wrapper}":{{"{wrapper}":[', {both}, ']}}')
        ELSE '' END"""


def _properties(orders: DataFrame) -> DataFrame:
    """Both properties of each kind of the three transformations as columns ``_kind_t_i``."""
    return orders.withColumns(
        {f"_{k}_{t}_{i}": F.expr(_at(_property_json(k), t=t, i=i)) for k in "SD" for t in range(3) for i in range(2)}
    )


_OBJECT_JSON = """concat('{',
    CASE (o_orderkey + t) % 17 WHEN 0 THEN '' WHEN 1 THEN '"$$ID":null,'
      ELSE concat('"$$ID":"O', o_orderkey, '_', t, '",') END,
    CASE o_custkey % 5 WHEN 0 THEN '"$$class":"12",' WHEN 1 THEN '"$$class":7,'
      WHEN 2 THEN '"$$class":"x",' WHEN 3 THEN '' ELSE '"$$class":null,' END,
    CASE o_custkey % 6 WHEN 0 THEN '"retainMetadata":true,'
      WHEN 1 THEN '"retainMetadata":" ON ",' WHEN 2 THEN '"retainMetadata":0,'
      WHEN 3 THEN '"retainMetadata":3,' WHEN 4 THEN '"retainMetadata":null,' ELSE '' END,
    CASE o_custkey % 4 WHEN 0 THEN '"fields":[{"n":1}],'
      WHEN 1 THEN '"fields":" [9] ",' WHEN 2 THEN '"fields":"plain",' ELSE '' END,
    '"objectName":"', o_orderstatus, '","path":"/p/', o_custkey, '"}')"""

_ADAPTER_JSON = f"""concat('{{"$$ID":"A', o_orderkey, '_', t, '","$$class":"ad","connectionId":"C',
    o_custkey % 50, '","objectType":"', o_orderstatus, '","readOptions":{{"r":', o_custkey,
    '}},"object":', CASE o_orderkey % 3 WHEN 0 THEN concat('[', {_OBJECT_JSON}, ']')
      WHEN 1 THEN {_OBJECT_JSON} ELSE '{{}}' END, '}}')"""

_TRANSFORMATION_JSON = f"""concat('{{"$$class":"', o_orderpriority, '"',
    CASE (o_orderkey + t) % 31 WHEN 0 THEN '' WHEN 1 THEN ',"$$ID":""' WHEN 2 THEN ',"$$ID":null'
      WHEN 3 THEN concat(',"$$ID":', o_orderkey * 10 + t)
      ELSE concat(',"$$ID":"T', o_orderkey, '_', t, '"') END,
    CASE (o_orderkey + t) % 7 WHEN 0 THEN concat(',"name":"src_', o_orderkey, '"')
      WHEN 1 THEN concat(',"name":"TGT_', o_orderkey, '"')
      WHEN 2 THEN concat(',"name":"Ff_', o_orderkey, '"')
      WHEN 3 THEN ',"name":"BI_CTRL_TRANSFORMACAO"'
      WHEN 4 THEN concat(',"name":"bad_', o_orderkey, '"') WHEN 5 THEN ''
      ELSE ',"name":"bi_ctrl_transformacao"' END,
    CASE (o_orderkey + t) % 6 WHEN 0 THEN concat(',"createTime":"', iso, 'Z"')
      WHEN 1 THEN ',"createTime":""' WHEN 2 THEN ',"createTime":"yesterday"'
      WHEN 3 THEN concat(',"createTime":"', iso, '.123Z"')
      WHEN 4 THEN concat(',"createTime":"', iso, '+02:00"') ELSE '' END,
    CASE (o_orderkey + t) % 3 WHEN 0 THEN ',"generateFilenamePort":"true"'
      WHEN 1 THEN ',"generateFilenamePort":true' ELSE '' END,
    CASE (o_orderkey + t) % 5 WHEN 0 THEN ',"inputSorted":true'
      WHEN 1 THEN r',"inputSorted":"\\"x\\""'
      WHEN 2 THEN ',"inputSorted":{{"a":1}}' WHEN 3 THEN ',"inputSorted":null' ELSE '' END,
    ',"groups":[{{"g":', o_custkey, '}}]',
    {_properties_json("S", "sessionProperties")},
    {_properties_json("D", "advancedProperties")},
    CASE (o_orderkey + t) % 5 WHEN 0 THEN concat(',"dataAdapter":', {_ADAPTER_JSON})
      WHEN 1 THEN concat(',"dataAdapter":[', {_ADAPTER_JSON}, ',{{"$$ID":"unused"}}]')
      WHEN 2 THEN ',"dataAdapter":{{}}' WHEN 3 THEN ',"dataAdapter":[]' ELSE '' END, '}}')"""

_CONTENT_JSON = f"""CASE WHEN o_orderkey % 97 = 5 THEN '{{"content": '
    WHEN o_orderkey % 97 = 6 THEN '[1, 2]' WHEN o_orderkey % 97 = 7 THEN '{{"other": 1}}'
    ELSE concat('{{"content":{{"$$class":"', o_orderstatus, '","name":"', {CONTENT_NAME}, '"',
      CASE o_orderkey % 53 WHEN 0 THEN '' WHEN 1 THEN ',"$$IID":""'
        ELSE concat(',"$$IID":"M', o_orderkey, '"') END,
      CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN ',"documentType":null'
        ELSE ',"documentType":"MAP"' END,
      CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN ',"annotations":null'
        ELSE concat(',"annotations":{{"z":', o_custkey, ', "a": [1, 2]}}') END,
      ',"transformations":', CASE WHEN o_orderkey % 10 = 3 THEN items
        ELSE concat('[', items, ']') END, '}}}}') END"""


def mapping_documents(
    spark: SparkSession, sf_dir: str, keep: Sequence[str] = (), deal: tuple[int, int] | None = None
) -> DataFrame:
    """One mapping document per order (of the deal): ``source_path, body`` and the kept order columns."""
    orders = spread(dealt(table(spark, sf_dir, "orders"), "o_orderkey", deal))
    timed = orders.withColumn(
        "iso",
        F.expr(
            "date_format(timestampadd(SECOND, o_orderkey % 86400, o_orderdate),"
            " \"yyyy-MM-dd'T'HH:mm:ss\")"
        ),
    )
    first, *others = (_at(_TRANSFORMATION_JSON.replace("_t_", f"_{t}_"), t=t) for t in range(3))
    others = ", ".join(f"IF(o_orderkey % 10 = 3, NULL, {other})" for other in others)
    items = _properties(timed).withColumn("items", F.expr(f"concat_ws(',', {first}, {others})"))
    return items.select(
        F.expr("concat('maps/', o_orderkey, '.json')").alias("source_path"),
        F.expr(_CONTENT_JSON.replace("varchar(20)", "string")).alias("body"),
        *keep,
    )


def task_documents(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """One task document per line item: ``source_path, body`` and the kept line columns."""
    items = spread(table(spark, sf_dir, "lineitem"))
    wave = wave_sql("l_suppkey")
    flag = """CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN 'true' WHEN 1 THEN '"Yes"'
        WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN '"no"' WHEN 5 THEN 'null' ELSE '"1"' END"""
    prop = f"""concat('{{"name":"', l_returnflag, '","value":', CAST(l_quantity AS int),
        ',"recommended":', {flag}, '}}')"""
    param = f"""concat('{{"id":"P', l_partkey, '","name":"', l_returnflag, '"',
        CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN ',"label":null'
          ELSE concat(',"label":"', l_linestatus, '"') END,
        ',"newObject":', {flag}, ',"isFileList":', CASE WHEN l_quantity > 25 THEN 'true'
          ELSE 'false' END,
        CASE l_linenumber % 4 WHEN 0 THEN ',"runtimeAttrs":null'
          WHEN 1 THEN concat(',"runtimeAttrs":{{"q":', CAST(l_quantity AS int), '}}') ELSE '' END,
        ',"overriddenFields":["', l_linestatus, '"]}}')"""
    name = TASK_NAME.replace("varchar(20)", "string")
    body = f"""concat('{{"name":"', {name}, '","parameters":',
        CASE l_linenumber % 3 WHEN 0 THEN {param} WHEN 1 THEN concat('[', {param}, ',', {param}, ']')
          ELSE '[]' END,
        ',"sessionPropertiesList":',
        CASE l_linenumber % 2 WHEN 0 THEN {prop} ELSE concat('[', {prop}, ',7]') END, '}}')"""
    return items.select(
        F.expr("concat('tasks/', l_orderkey, '_', l_linenumber)").alias("source_path"),
        F.expr(body).alias("body"),
        *keep,
    )


TASK_NAME = (
    f"concat('mt_ld_x_', {wave_sql('l_suppkey')}, '_', CAST(l_suppkey % 100 AS varchar(20)), '_',"
    " CAST(l_orderkey AS varchar(20)), '_', CAST(l_linenumber AS varchar(20)))"
)


_PACKED_ROWS, _PACKED_BYTES = 250, 2_000_000  # packages handed on in one batch at most


def zipped(docs: DataFrame, member: str, suffix: str) -> DataFrame:
    """Documents as zip packages (``path``, ``content``); an empty body gives a broken one."""

    def packed(body: str | None) -> bytes:
        buffer = io.BytesIO()
        if body:
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("info.txt", "package")
                archive.writestr(member, body)
        return buffer.getvalue()

    def batch_of(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"]
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents, size = [], [], 0
            for path, body in zip(batch.column("path"), batch.column("body")):
                paths.append(path.as_py())
                contents.append(packed(body.as_py()))
                size += len(contents[-1])
                if len(paths) == _PACKED_ROWS or size > _PACKED_BYTES:
                    yield batch_of(paths, contents)
                    paths, contents, size = [], [], 0
            yield batch_of(paths, contents)

    named = docs.select(F.concat("source_path", F.lit(suffix)).alias("path"), "body")
    return named.mapInArrow(pack, "path string, content binary")


def written(files: DataFrame, folder: str) -> str:
    """Writes every row (``path`` below the folder, ``content``) to a file of its own; gives the folder."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        made: set[str] = set()
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                target = f"{root}/{path}"
                parent = target.rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(target) as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    files.select("path", "content").mapInArrow(write, "n long").agg(F.sum("n")).collect()  # one number
    return folder


def removed(spark: SparkSession, folders: Sequence[str]) -> None:
    """Deletes folders, each in a task; those that are not there are passed over."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column("path").to_pylist():
                system, name = fs.FileSystem.from_uri(folder)
                if system.get_file_info(name).type != fs.FileType.NotFound:
                    system.delete_dir(name)
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    paths = spark.createDataFrame([(folder,) for folder in folders], "path string")
    paths = paths.repartition(max(1, min(len(folders), 4 * spark.sparkContext.defaultParallelism)))
    paths.mapInArrow(remove, "n long").agg(F.sum("n")).collect()  # one number


def file_record_documents(spark: SparkSession, sf_dir: str, deal: tuple[int, int] | None = None) -> DataFrame:
    """One file-record document per event (of the deal), in every root shape and with unusable records."""
    ident = """CASE event_id % 7 WHEN 0 THEN concat('"id":"@', event_id, '",')
        WHEN 2 THEN concat('"id":', event_id, ',') WHEN 3 THEN '"id":"@x",' WHEN 6 THEN ''
        ELSE concat('"id":"', event_id, '",') END"""
    attach = """CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN '"attachTime":null,'
        WHEN 2 THEN '"attachTime":"soon",' ELSE concat('"attachTime":', timestampdiff(
          MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts), ',') END"""
    record = f"""concat('{{"@type":"', IF(event_id % 13 = 0, 'folder', 'fileRecord'), '",',
        {ident}, {attach},
        CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('"type":"', event_type, '",') END,
        CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('"size":', user_id, ',') END,
        '"records":null,"name":"f', user_id, '_x', event_id, '.bin"}}')"""
    plain = f"replace({record}, '\"records\":null,', '')"
    body = f"""CASE event_id % 5 WHEN 0 THEN concat('[', {plain}, ',{{"@type":"other"}}]')
        WHEN 1 THEN {plain} WHEN 2 THEN concat('{{"records":[', {plain}, ']}}')
        WHEN 3 THEN concat('[', {record}, ']') ELSE 'no json' END"""
    return spread(dealt(table(spark, sf_dir, "events"), "event_id", deal)).select(
        F.expr("concat('records/', event_id)").alias("source_path"), F.expr(body).alias("body")
    )


def connection_documents(spark: SparkSession, sf_dir: str, deal: tuple[int, int] | None = None) -> DataFrame:
    """One connection document per customer (of the deal), as an object or an array."""
    iso = """date_format(timestampadd(HOUR, c_custkey, TIMESTAMP_NTZ'2024-01-01 00:00:00'),
        "yyyy-MM-dd'T'HH:mm:ss'Z'")"""
    record = f"""concat('{{"@type":"', IF(c_custkey % 10 < 8, 'connection', 'agent'), '",',
        '"id":"', IF(c_custkey % 2 = 0, '@', ''), 'C', c_custkey, '","name":"', c_name, '",',
        CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN '"description":null,'
          ELSE concat('"description":"', c_mktsegment, '",') END,
        '"port":', 1000 + c_nationkey, ',"type":"', c_mktsegment, '","host":"', c_nationkey, '",',
        '"password":"secret', c_custkey, '",',
        CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN '"majorUpdateTime":"later",'
          ELSE concat('"majorUpdateTime":"', {iso}, '",') END,
        CASE c_custkey % 4 WHEN 0 THEN '"internal":true,' WHEN 1 THEN '"internal":"true",'
          WHEN 2 THEN concat('"internal":null,"connParams":{{"a":"', c_mktsegment, '"}},')
          ELSE '"connParams":{{}},' END,
        CASE c_custkey % 5 WHEN 0 THEN '"federatedId":null' WHEN 1 THEN '"federatedId":""'
          ELSE concat('"federatedId":"f', c_custkey, '"') END, '}}')"""
    return spread(dealt(table(spark, sf_dir, "customer"), "c_custkey", deal)).select(
        F.expr("concat('connections/', c_custkey)").alias("source_path"),
        F.expr(f"IF(c_custkey % 3 = 0, {record}, concat('[', {record}, ']'))").alias("body"),
    )


def export_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One export list per text document: an own, a foreign and a code-less object."""
    project = wave_sql("doc_id")
    docs = spread(table(spark, sf_dir, "documents")).withColumn("project", F.expr(project))
    foreign = "concat('x9_', project)"

    def exported(i: int, name: str, info: str) -> str:
        return (
            f"named_struct('objectGuid', concat('g', doc_id, '_{i}'), 'objectName', {name},"
            f" 'objectType', source, 'metadata', {info})"
        )

    with_info = (
        "named_struct('additionalInfo', named_struct('description', text, 'contentType', lang))"
    )
    none = "CAST(NULL AS struct<additionalInfo: struct<description: string, contentType: string>>)"
    objects = ", ".join(
        [
            exported(0, "concat('o_', project, '_', doc_id)", with_info),
            exported(1, "concat('plain ', lang)", none),
            exported(2, foreign, with_info),
        ]
    )
    return docs.select(
        F.expr("concat('exports/', doc_id)").alias("source_path"),
        "project",
        F.to_json(F.struct(F.expr(f"array({objects})").alias("exportedObjects"))).alias("body"),
    )


def package_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One package-list row per part."""
    name = f"""concat(IF(p_partkey % 4 = 1, 'tf_', 'm_a_b_'), {wave_sql("p_partkey")}, '_', p_size)"""
    kind = "element_at(array('MTT', 'TASKFLOW', 'DTEMPLATE', 'Project'), int(p_partkey % 4) + 1)"
    return table(spark, sf_dir, "part").select(
        F.expr("concat('id', p_partkey)").alias("id"),
        F.expr("concat('/Explore/', p_name)").alias("objectPath"),
        F.expr(name).alias("objectName"),
        F.expr(kind).alias("objectType"),
    )
