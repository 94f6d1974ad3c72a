"""Task-flow exports: XML files cut into items by a text scan and parsed by built-in functions.

A file is read as text that is cut at the end tag of an item, so one large file is split over
tasks; each item is then parsed on its own by ``from_xml`` with a declared schema.  What stands
outside the items (root, server time) is put together for each file and parsed as well, which
tells whether the file as a whole is well-formed.

Elements and attributes are matched by their local names.  The prefix of the items' name space
is looked up in each file; files are UTF-8, US-ASCII or ISO-8859-1, as their first line says.  An item's
end tag inside a comment or CDATA section makes the file a reject.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import stored

# The name spaces of the export format.
_BASE = "http://schemas.active-endpoints.com/appmodules/"
NAMESPACES = {
    "types1": _BASE + "repository/2010/10/avrepository.xsd",
    "ns0": _BASE + "screenflow/2010/10/avosScreenflow.xsd",
    "ns2": _BASE + "screenflow/2011/06/avosHostEnvironment.xsd",
}


_TEXT = "_VALUE"  # where from_xml puts the text pieces of an element
_MARK = "\ue000"  # put behind start tags: tells leading text from later pieces, and keeps blank text
_TEXTS = T.ArrayType(T.StringType())


def _local(name: str) -> str:
    return name.rpartition(":")[2]


@dataclass
class _Shape:
    """What to read from an element; it gives the Spark type and drives the reading.

    ``texts`` are child elements read for their leading text; ``ones`` nested children;
    ``lists`` repeated children, inside a wrapper element if the path has two steps.
    """

    ns: str = "ns0"
    attributes: Sequence[str] = ()
    texts: Sequence[str] = ()
    own_text: bool = False
    ones: dict[str, tuple[str, "_Shape"]] = field(default_factory=dict)
    lists: dict[str, tuple[str, "_Shape"]] = field(default_factory=dict)

    def spark_type(self) -> T.StructType:
        names = [*self.attributes, *self.texts, *(["text"] if self.own_text else [])]
        struct = T.StructType([T.StructField(n, T.StringType()) for n in names])
        for name, (_, shape) in self.ones.items():
            struct.add(name, shape.spark_type())
        for name, (_, shape) in self.lists.items():
            struct.add(name, T.ArrayType(shape.spark_type()))
        return struct

    def xml_type(self) -> T.StructType:
        """The type that ``from_xml`` reads: every child is a list, as it may be repeated."""
        struct = T.StructType([T.StructField(f"_{a}", T.StringType()) for a in self.attributes])
        if self.own_text:
            struct.add(_TEXT, _TEXTS)
        for name in self.texts:
            struct.add(name, _TEXTS)
        for path, shape in [*self.ones.values(), *self.lists.values()]:
            *wrapper, step = map(_local, path.split("/"))
            kind = T.ArrayType(shape.xml_type())
            for outer in wrapper:
                struct.add(outer, T.ArrayType(T.StructType([T.StructField(step, kind)])))
            if not wrapper:
                struct.add(step, kind)
        return struct

    def texts_marked(self) -> set[str]:
        """Local names of the elements below whose own text is read."""
        found = set()
        for path, shape in [*self.ones.values(), *self.lists.values()]:
            found |= shape.texts_marked() | ({_local(path)} if shape.own_text else set())
        return found

    def row(self, element: Column) -> Column:
        """A parsed element as a value of :meth:`spark_type`: the first child of each name counts."""
        columns = [element[f"_{a}"].alias(a) for a in self.attributes]
        columns += [F.get(element[name], F.lit(0)).alias(name) for name in self.texts]
        if self.own_text:
            # the piece behind the start tag; pieces behind child elements are no text of this one
            own = F.get(F.filter(element[_TEXT], lambda piece: piece.startswith(_MARK)), F.lit(0))
            columns.append(F.nullif(F.substr(own, F.lit(2)), F.lit("")).alias("text"))
        for name, (path, shape) in self.ones.items():
            child = F.get(element[_local(path)], F.lit(0))
            columns.append(F.when(child.isNotNull(), shape.row(child)).alias(name))
        for name, (path, shape) in self.lists.items():
            *wrapper, step = map(_local, path.split("/"))
            for outer in wrapper:
                element_of = F.get(element[outer], F.lit(0))
                found = element_of[step]
            if not wrapper:
                found = element[step]
            columns.append(F.coalesce(F.transform(found, shape.row), F.array().cast(T.ArrayType(shape.spark_type()))).alias(name))
        return F.struct(*columns)


# Element and attribute names of the export format.
_OPERATION = _Shape(attributes=["source", "to"], own_text=True)
_PARAMETER = _Shape(
    attributes=["name", "source"],
    own_text=True,
    lists={"operations": ("ns0:operation", _OPERATION)},
)
_SERVICE = _Shape(
    attributes=["id"],
    texts=["title", "serviceName", "serviceGUID"],
    lists={
        "inputs": ("ns0:serviceInput/ns0:parameter", _PARAMETER),
        "outputs": ("ns0:serviceOutput/ns0:operation", _OPERATION),
    },
)
_FLOW = _Shape(
    attributes=["id"],
    ones={
        "start": (
            "ns0:start",
            _Shape(
                attributes=["id"],
                ones={"link": ("ns0:link", _Shape(attributes=["targetId"]))},
            ),
        )
    },
    lists={
        "containers": ("ns0:eventContainer", _Shape(lists={"services": ("ns0:service", _SERVICE)}))
    },
)
_TASKFLOW = _Shape(
    attributes=["displayName", "name", "overrideAPIName"],
    texts=["description", "tags", "generator"],
    ones={
        "deployment": (
            "ns0:deployment",
            _Shape(
                attributes=["skipIfRunning", "suspendOnFault"],
                texts=["tracingLevel"],
                lists={"groups": ("ns0:allowedGroups/ns0:group", _Shape(own_text=True))},
            ),
        ),
        "flow": ("ns0:flow", _FLOW),
    },
    lists={
        "fields": (
            "ns0:tempFields/ns0:field",
            _Shape(
                attributes=["description", "name", "type"],
                lists={
                    "options": (
                        "ns0:options/ns0:option",
                        _Shape(attributes=["name"], own_text=True),
                    )
                },
            ),
        ),
        "dependencies": ("ns0:dependencies/ns2:processObject", _Shape(attributes=["name"])),
    },
)
_ITEM = _Shape(
    ns="types1",
    texts=[
        "EntryId", "Name", "MimeType", "Description", "AppliesTo", "Tags", "VersionLabel",
        "State", "ProcessGroup", "CreatedBy", "CreationDate", "ModifiedBy", "ModificationDate",
        "PublicationStatus", "PublishedBy", "PublicationDate", "PublishedContributionId",
        "GUID", "DisplayName",
    ],
    ones={"Entry": ("types1:Entry", _Shape(ones={"taskflow": ("ns0:taskflow", _TASKFLOW)}))},
)

ITEM_PREFIX = "types1"
_MOST_PREFIXES = 16
_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}
_CORRUPT = T.StructField("_corrupt_record", T.StringType())
_ITEM_XML = T.StructType([*_ITEM.xml_type().fields, _CORRUPT])
_FRAME_XML = T.StructType([T.StructField("CurrentServerDateTime", _TEXTS), _CORRUPT])
_MARKED = rf"""(<(?:[\w.-]+:)?(?:{"|".join(sorted(_ITEM.texts_marked()))})\b(?:[^<>"']++|"[^"]*+"|'[^']*+')*+(?<!/)>)"""
_NAME_SPACE = rf"""xmlns(?::([\w.-]+))?\s*=\s*["']{NAMESPACES["types1"].replace(".", "[.]")}["']"""
_ENCODING = r"""^\uFEFF?<\?xml[^>]*?\sencoding\s*=\s*["']([\w.:-]+)["']"""
_UTF8, _LATIN1 = ("", "utf-8", "utf8", "us-ascii", "ascii"), ("iso-8859-1", "latin1", "latin-1")


def _tag(prefix: str) -> str:
    return f"{prefix}:Item" if prefix else "Item"


def _records(spark: SparkSession, paths: str | Sequence[str], name_filter: str, prefix: str) -> DataFrame:
    """``source_path, pos, raw``: the text up to each end tag of an item, in any order."""
    files = spark.read.text(
        paths if isinstance(paths, str) else list(paths), lineSep=f"</{_tag(prefix)}>", pathGlobFilter=name_filter
    )
    # rows of one split keep their order, and the split's first byte gives its place in the file
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return files.select(F.col("_metadata.file_path").alias("source_path"), place.alias("pos"), F.col("value").cast("binary").alias("raw"))


def _heads(records: DataFrame) -> DataFrame:
    """``source_path, charset, prefix`` of the files that declare one of these in their first block."""
    head = F.col("raw").cast("string")
    found = records.where("pos.block = 0").select(
        "source_path",
        F.nullif(F.lower(F.regexp_extract(head, _ENCODING, 1)), F.lit("")).alias("charset"),
        F.when(head.contains(NAMESPACES["types1"]), F.struct("pos", F.regexp_extract(head, _NAME_SPACE, 1).alias("prefix"))).alias("space"),
    )
    found = found.where("charset is not null or space is not null").groupBy("source_path")
    return found.agg(F.max("charset").alias("charset"), F.min("space").alias("space")).select("source_path", "charset", "space.prefix")


def _decoded(records: DataFrame, heads: DataFrame) -> DataFrame:
    """``source_path, pos, text, error``."""
    charset = F.coalesce("charset", F.lit(""))
    known = records.join(heads.where(~charset.isin(*_UTF8)).select("source_path", "charset"), "source_path", "left")
    plain = F.col("raw").cast("string")
    text = F.when(charset.isin(*_LATIN1), F.decode("raw", "ISO-8859-1")).when(F.is_valid_utf8(plain), plain)
    error = F.when(~charset.isin(*_UTF8, *_LATIN1), F.concat(F.lit("unknown encoding "), charset)).when(
        text.isNull(), F.lit("not an XML document: bytes that are no UTF-8")
    )
    return known.select("source_path", "pos", F.when(error.isNull(), text).alias("text"), error.alias("error"))


def _parsed(texts: DataFrame, prefix: str) -> DataFrame:
    """Item rows and one error row for each broken file, from ``source_path, pos, text, error``."""
    tag = _tag(prefix)
    empty_item = rf"<{tag}(\s[^<>]*)?/>"
    start = rf"(?s)<{tag}(?=[\s>]).*"
    cut = texts.withColumn("text", F.regexp_replace("text", empty_item, ""))
    item = F.regexp_extract("text", start, 0)
    cut = cut.withColumns({"item": item, "lead": F.expr("left(text, length(text) - length(item))")})
    marked = F.concat(F.regexp_replace("item", _MARKED, f"$1{_MARK}"), F.lit(f"</{tag}>"))
    cut = cut.withColumn("x", F.when(F.col("item") != "", F.from_xml(marked, _ITEM_XML, _OPTIONS)))
    broken = F.when(F.col("x._corrupt_record").isNotNull(), F.lit("not an XML document: a broken item"))
    rows = cut.select(
        "source_path",
        "pos",
        F.when(F.trim("lead") != "", F.col("lead")).alias("lead"),
        F.when(F.col("item") != "", _ITEM.row(F.col("x"))).alias("item"),
        F.coalesce("error", broken).alias("error"),
    )
    rows = stored(rows, "taskflow_items")  # parsed once for the items and for what is said about their files
    pieces = F.sort_array(F.collect_list(F.when(F.col("lead").isNotNull(), F.struct("pos", "lead"))))
    frame = F.ltrim(F.array_join(F.transform(pieces, lambda x: x["lead"]), ""), F.lit("\ufeff"))
    files = rows.groupBy("source_path").agg(F.max("error").alias("error"), frame.alias("frame"))
    files = files.withColumn("x", F.from_xml(F.trim("frame"), _FRAME_XML, _OPTIONS))
    broken = F.when(F.col("x._corrupt_record").isNotNull(), F.lit("not an XML document"))
    files = files.select(
        "source_path", F.get("x.CurrentServerDateTime", F.lit(0)).alias("server_time"), F.coalesce("error", broken).alias("error")
    )
    files = stored(files, "taskflow_files")
    good = rows.drop("error", "lead").where("item is not null").join(files.where("error is null"), "source_path")
    nothing = [F.lit(None).cast(ITEM_SCHEMA[c].dataType).alias(c) for c in ("pos", "server_time", "item")]
    return good.select(*ITEM_SCHEMA.names).union(files.where("error is not null").select("source_path", *nothing, "error"))


ITEM_SCHEMA = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("pos", T.StructType([T.StructField("block", T.LongType()), T.StructField("row", T.LongType())])),
        T.StructField("server_time", T.StringType()),
        T.StructField("item", _ITEM.spark_type()),
        T.StructField("error", T.StringType()),
    ]
)


def parse_taskflows(files: DataFrame) -> DataFrame:
    """One row per item of every file (``path``, ``content``); a broken file is an error row.

    ``pos`` orders the items of a file.  The usual prefix of the items is expected here.
    """
    pieces = F.split(F.col("content").cast("string"), f"</{_tag(ITEM_PREFIX)}>")
    records = files.select(F.col("path").alias("source_path"), F.posexplode(pieces).alias("row", "raw"))
    place = F.struct(F.lit(0).cast("long").alias("block"), F.col("row").cast("long").alias("row"))
    records = records.select("source_path", place.alias("pos"), F.col("raw").cast("binary").alias("raw"))
    return _parsed(_decoded(records, stored(_heads(records), "taskflow_heads")), ITEM_PREFIX)


def scan_taskflow_xml(spark: SparkSession, paths: str | Sequence[str], name_filter: str = "*.xml") -> DataFrame:
    """Items of every matching file under ``paths``; the columns of :func:`parse_taskflows`.

    Files whose items have another prefix are read again, cut at their own end tag.
    """
    records = _records(spark, paths, name_filter, ITEM_PREFIX)
    heads = stored(_heads(records), "taskflow_heads")
    prefix = F.coalesce("prefix", F.lit(ITEM_PREFIX))
    odd = [r[0] for r in heads.where(prefix != ITEM_PREFIX).select("prefix").distinct().orderBy("prefix").limit(_MOST_PREFIXES).collect()]
    if not odd:
        return _parsed(_decoded(records, heads), ITEM_PREFIX)
    others = heads.where(prefix != ITEM_PREFIX).select("source_path")
    found = _parsed(_decoded(records.join(others, "source_path", "left_anti"), heads), ITEM_PREFIX)
    for other in odd:
        mine = heads.where(prefix == other).select("source_path")
        again = _records(spark, paths, name_filter, other).join(mine, "source_path", "left_semi")
        found = found.union(_parsed(_decoded(again, heads), other))
    unread = heads.where(~prefix.isin(ITEM_PREFIX, *odd)).select(
        "source_path",
        *[F.lit(None).cast(ITEM_SCHEMA[c].dataType).alias(c) for c in ("pos", "server_time", "item")],
        F.lit("too many prefixes for one name space").alias("error"),
    )
    return found.union(unread)
