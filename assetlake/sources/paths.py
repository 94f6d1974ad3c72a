"""Project folders and the paths of their asset packages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Folder names of an export tree.
EXPLORE, SYSTEM, TASKFLOW_FOLDER = "Explore", "SYS", "Geral"


def project_folders(
    projects: DataFrame,
    folders: DataFrame,
    codes: Sequence[int] | None = None,
    with_folder: bool = True,
) -> DataFrame:
    """Distinct projects with their folders and the label ``<code>_<name>``.

    ``with_folder=False`` keeps one row per project that owns a folder.
    """
    if codes is not None:
        projects = projects.filter(F.col("cod_projeto").isin(list(codes)))
    label = F.concat_ws("_", F.col("cod_projeto").cast("string"), "nme_projeto")
    base = projects.select("cod_projeto", "nme_projeto", label.alias("project_label"))
    if with_folder:
        pairs = folders.select("cod_projeto", "pasta").distinct()
        return base.distinct().join(pairs, "cod_projeto")
    return base.distinct().join(folders.select("cod_projeto"), "cod_projeto", "left_semi")


def project_label(projects: DataFrame, code: int) -> DataFrame:
    """At most one row: code, name and label of one project."""
    label = F.concat_ws("_", F.col("cod_projeto").cast("string"), "nme_projeto")
    return (
        projects.filter(F.col("cod_projeto") == code)
        .select("cod_projeto", "nme_projeto", label.alias("project_label"))
        .limit(1)
    )


def asset_paths(
    spark: SparkSession, base: str, folders: DataFrame, area: str = EXPLORE
) -> list[str]:
    """Existing asset folders of the given projects, sorted.

    ``folders`` comes from :func:`project_folders` for the project codes of the run.
    """
    base = base.replace("\\", "/").rstrip("/")
    root = F.concat_ws("/", F.lit(base), "project_label")
    if area == SYSTEM:
        path = F.concat_ws("/", root, F.lit(SYSTEM))
    else:
        path = F.concat_ws("/", root, F.lit(EXPLORE), "project_label", "pasta")
    return existing_paths(spark, folders.select(path.alias("path")).distinct())


def existing_paths(spark: SparkSession, paths: Sequence[str] | DataFrame) -> list[str]:
    """The paths (a list or a frame with ``path``) that are there, sorted; missing ones are skipped.

    The paths are looked up in tasks.  Those on a file system that only the JVM reads are looked up
    from here.
    """
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in set(paths)], "path string")
    found = with_existence(paths).where("coalesce(found, true)").collect()
    conf = spark._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(conf).exists(folder)

    return sorted(r["path"] for r in found if r["found"] or there(r["path"]))


def with_existence(paths: DataFrame) -> DataFrame:
    """``path`` and whether it is there; NULL where tasks can't read its file system."""
    spark = paths.sparkSession
    # a path without a scheme is one of the cluster's file system
    root = spark._jvm.org.apache.hadoop.fs.Path("/").getFileSystem(spark._jsc.hadoopConfiguration()).getUri().toString()
    root = root.rstrip("/") if not root.startswith("file:") else ""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            found: list[bool | None] = []
            for path in batch.column("path").to_pylist():
                try:
                    system, name = fs.FileSystem.from_uri(root + path if path.startswith("/") else path)
                    found.append(system.get_file_info(name).type != fs.FileType.NotFound)
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.bool_())], ["path", "found"])

    return paths.select("path").mapInArrow(look_up, "path string, found boolean")


def with_path_columns(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Adds ``project_label``, ``CodOnda`` (its code) and ``folder`` read off the path."""
    path = F.translate(F.col("source_path") if path is None else path, "\\", "/")
    label = F.coalesce(
        F.nullif(F.regexp_extract(path, r"/([^/]+)/(?:Explore|SYS)/", 1), F.lit("")),
        F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1),
    )
    return df.withColumns(
        {
            "project_label": label,
            "CodOnda": F.substring_index(label, "_", 1),
            "folder": F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1),
        }
    )
