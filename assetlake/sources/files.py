"""Whole files as binary rows."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from fnmatch import fnmatchcase
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import stored

# A row holds at most 2 GiB; a larger file goes to its task as a path and is opened there.
ROW_BYTES = 2_000_000_000
# Files, and bytes of them, that one task reads, about; rows and bytes of a batch it hands on.
_TASK_FILES, _TASK_BYTES = 5000, 128 << 20
_BATCH_FILES, _BATCH_BYTES = 1000, 8 << 20
# What a path's URI writes as per cent and hexadecimal digits.
_URI_QUOTED = re.compile(r"[\x00-\x20\"#%<>?\[\\\]^`{|}\x7f]")


def binary_files(spark: SparkSession, paths: str | Sequence[str], name_filter: str) -> DataFrame:
    """``path, content`` of every file; ``content`` is NULL for files that no row can hold.

    Folders are listed and files read in tasks, so the driver holds no file names.  Where tasks can't
    read the file system, or a path is a pattern, Spark's scan does both: its length filters are pushed
    down, small files are read by the one, of large files the other gives the path only.
    """
    listed = listed_files(spark, paths, name_filter)
    if listed is not None:
        return read_files(listed).select("path", "content")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_filter)
        .load(paths if isinstance(paths, str) else list(paths))
    )
    small = files.filter(F.col("length") <= ROW_BYTES).select("path", "content")
    large = files.filter(F.col("length") > ROW_BYTES).select(
        "path", F.lit(None).cast("binary").alias("content")
    )
    return small.union(large)


def listed_files(spark: SparkSession, paths: str | Sequence[str], name_filter: str) -> DataFrame | None:
    """The files that Spark's scans find in the folders, listed in tasks: ``path``, ``root, name`` to open it by, ``length``.

    As in those scans, files without a byte and hidden ones are none, and of subfolders only those named
    as partitions (``key=value``) are entered.  None where only Spark can list the paths.
    """
    roots = _task_roots(spark, [paths] if isinstance(paths, str) else list(paths))
    if not roots or set(name_filter) & set("{[\\"):
        return None

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * 4
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "root", "name", "length"])

    def files_in(system, info) -> Iterator:
        from pyarrow import fs

        if info.type == fs.FileType.File:
            yield info
        elif info.type == fs.FileType.Directory:
            for entry in system.get_file_info(fs.FileSelector(info.path)):
                name = entry.base_name
                hidden = name.startswith(".") or name.startswith("_") and "=" not in name
                if not hidden and (entry.type == fs.FileType.File or "=" in name):
                    yield from files_in(system, entry)

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for root in batch.column("root").to_pylist():
                system, folder = fs.FileSystem.from_uri(root)
                shown = root.replace("file:///", "file:/", 1)  # as Spark spells it
                found: list[tuple] = []
                for info in files_in(system, system.get_file_info(folder)):
                    if info.size and fnmatchcase(info.base_name, name_filter):
                        found.append((shown + info.path[len(folder) :], root, info.path, info.size))
                    if len(found) == 10_000:
                        yield batch_of(found)
                        found = []
                yield batch_of(found)

    folders = spark.createDataFrame([(root,) for root in roots], "root string")
    folders = folders.repartition(min(len(roots), 4 * spark.sparkContext.defaultParallelism))
    return stored(folders.mapInArrow(listing, "path string, root string, name string, length long"), "files")


def _task_roots(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths as tasks open them; none if one is a pattern, missing or of a file system of the JVM's own."""
    from pyarrow import fs

    roots, conf = set(), spark._jsc.hadoopConfiguration()
    for path in paths:
        if set(path) & set("*?[]{}\\%# "):
            return []
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(conf)
        uri = system.makeQualified(folder).toString()
        uri = uri.replace("file:/", "file:///", 1) if not uri.startswith("file://") else uri
        try:
            fs.FileSystem.from_uri(uri)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            return []
        if not system.exists(folder):
            return []
        roots.add(uri)
    return sorted(roots)


def read_files(listed: DataFrame) -> DataFrame:
    """``path``, the same as a URI in ``uri``, and ``content`` of listed files; NULL if no row can hold it.

    As many tasks read as the number and bytes of the files ask for.
    """
    n, size = listed.agg(F.count("path"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(listed.sparkSession.sparkContext.defaultParallelism, n // _TASK_FILES + 1, size // _TASK_BYTES + 1)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        paths, uris, contents = zip(*rows, strict=True) if rows else ((), (), ())
        columns = [pa.array(paths, pa.string()), pa.array(uris, pa.string()), pa.array(contents, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["path", "uri", "content"])

    def reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        systems: dict[str, fs.FileSystem] = {}
        for batch in batches:
            rows, held = [], 0
            for path, root, name, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if rows and (len(rows) == _BATCH_FILES or held + length > _BATCH_BYTES):
                    yield batch_of(rows)
                    rows, held = [], 0
                if root not in systems:
                    systems[root] = fs.FileSystem.from_uri(root)[0]
                content = None
                if length <= ROW_BYTES:
                    with systems[root].open_input_stream(name) as file:
                        content = file.read()
                    held += length
                rows.append((path, _URI_QUOTED.sub(lambda m: f"%{ord(m[0]):02X}", path), content))
            yield batch_of(rows)

    files = listed.select("path", "root", "name", "length").repartition(tasks, "path")
    return files.mapInArrow(reading, "path string, uri string, content binary")


def opened(path: str, content: bytes | None) -> BinaryIO:
    """A file as a seekable stream: its bytes, or its path where the bytes did not fit a row."""
    if content is not None:
        return io.BytesIO(content)
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)
