"""Archive packages: the members of interest of every zip file."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import asset_name
from .files import binary_files, opened

# Package kinds as (file suffix, ending of the wanted member).
MAPPINGS = (".DTEMPLATE.zip", "@3.bin")
FILE_RECORDS = (".DTEMPLATE.zip", "fileRecord.json")
TASKS = (".MTT.zip", "mtTask.json")
CONNECTIONS = (".Connection.zip", "connection.json")

Member = tuple[str | None, str | None]  # body, error


def _open_member(archive: zipfile.ZipFile, ending: str) -> Member:
    member = next((n for n in archive.namelist() if n.endswith(ending)), None)
    if member is None:
        return None, "member not found"
    if archive.getinfo(member).file_size > _TEXT_BYTES:
        return None, "member is longer than a text value can be"
    try:
        return archive.read(member).decode("utf-8"), None
    except UnicodeDecodeError:
        return None, "member is not UTF-8 text"


def _read_members(path: str, content: bytes | None, endings: Sequence[str]) -> list[Member]:
    try:
        with opened(path, content) as file, zipfile.ZipFile(file) as archive:
            return [_open_member(archive, ending) for ending in endings]
    except zipfile.BadZipFile:
        reason = "corrupt archive"
    except Exception as error:  # one bad package must not stop the load
        reason = f"{type(error).__name__}: {error}"
    return [(None, reason)] * len(endings)


# Packages handed on in one batch at most; a batch ends earlier at this many characters.
_BATCH_ROWS, _BATCH_CHARS = 1000, 8_000_000
_TEXT_BYTES = 2**31 - 64  # the most that one text value holds
_MEMBER = pa.struct([("body", pa.string()), ("error", pa.string())])


def unzip_packages(files: DataFrame, suffix: str, members: dict[str, str]) -> DataFrame:
    """One row per package: ``source_path, asset_name`` and a struct per wanted member.

    ``files`` has ``path`` and ``content``; ``members`` gives the name ending per column.
    The first member with the ending is taken into ``body``; where there is none, or the
    package is broken, ``error`` says so.  A package is opened once for all its members.
    """
    names, endings = list(members), list(members.values())

    def batch_of(paths: list[str], rows: list[list[Member]]) -> pa.RecordBatch:
        columns = [
            pa.array([dict(zip(("body", "error"), row[i])) for row in rows], _MEMBER)
            for i in range(len(names))
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), *columns], names=["source_path", *names]
        )

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, rows, size = [], [], 0
            for path, content in zip(batch.column("path"), batch.column("content")):
                found = _read_members(path.as_py(), content.as_py(), endings)
                length = sum(len(body or "") for body, _ in found)
                if len(rows) == _BATCH_ROWS or rows and size + length > _BATCH_CHARS:
                    yield batch_of(paths, rows)
                    paths, rows, size = [], [], 0
                paths.append(path.as_py())
                rows.append(found)
                size += length
            yield batch_of(paths, rows)

    schema = ", ".join(f"`{n}` struct<body string, error string>" for n in names)
    packages = files.select("path", "content").mapInArrow(unzip, f"source_path string, {schema}")
    return packages.select("source_path", _asset(suffix), *names)


def unzip_members(files: DataFrame, suffix: str, ending: str) -> DataFrame:
    """One member per package: ``source_path, asset_name, body, error``."""
    packages = unzip_packages(files, suffix, {"member": ending})
    return packages.select("source_path", "asset_name", "member.body", "member.error")


def _asset(suffix: str) -> Column:
    return asset_name(F.col("source_path"), suffix).alias("asset_name")


def scan_packages(
    spark: SparkSession, paths: str | Sequence[str], suffix: str, members: dict[str, str]
) -> DataFrame:
    """Packages under ``paths`` with the given file suffix, unzipped."""
    return unzip_packages(binary_files(spark, paths, f"*{suffix}"), suffix, members)


def scan_archives(
    spark: SparkSession, paths: str | Sequence[str], suffix: str, ending: str
) -> DataFrame:
    """One member of the packages under ``paths``: ``source_path, asset_name, body, error``."""
    packages = scan_packages(spark, paths, suffix, {"member": ending})
    return packages.select("source_path", "asset_name", "member.body", "member.error")
