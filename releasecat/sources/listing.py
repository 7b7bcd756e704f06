"""Sizes of physical files, looked up by tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..functions.globs import glob_to_regex
from ..session import cut_lineage

# File systems that a task reaches without Spark; s3a is Hadoop's name for s3.
TASK_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")
_ENTRY = "uri string, name string, size long"


def open_uri(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system of a URI and the path there."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return arrow_fs.FileSystem.from_uri(uri.replace("s3a:", "s3:", 1) if scheme == "s3a" else uri)


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Path and size of all files under a root, ``file, size``.  File contents are not read.

    Folders are listed by tasks, level by level, and what they find is stored; the driver learns only whether a level
    had folders.  One folder is one task's list.  Names that begin with ``_`` or a dot are left out, as by Spark.
    ``pattern`` is a glob for file names.  A root that does not exist is an error.  On file systems that tasks do not
    reach (see ``TASK_SCHEMES``) Spark's own file index is used, which the driver holds.
    """
    if not fs.exists(spark, root):
        raise FileNotFoundError(root)
    start = fs.qualified(spark, root)
    if start.partition(":")[0] not in TASK_SCHEMES:
        return _indexed_files(spark, root, pattern)
    levels, folders = [], spark.createDataFrame([(start,)], "uri string")
    while True:
        level = cut_lineage(folders.mapInArrow(_entries, _ENTRY), "listing")
        levels.append(level.where(F.col("size").isNotNull()))
        folders = level.where(F.col("size").isNull()).select("uri").hint("rebalance", "uri")
        if folders.isEmpty():
            break
    files = reduce(DataFrame.unionByName, levels)
    if pattern is not None:
        files = files.where(F.col("name").rlike(glob_to_regex(pattern)))
    return files.select(F.col("uri").alias("file"), "size")


def file_sizes(files: DataFrame, file: str = "file") -> DataFrame:
    """Add the ``size`` of each named file, asked for by tasks; NULL where there is none, or no name.

    For records that name their files this replaces a listing of whole folders.  Names are URIs with a scheme of
    ``TASK_SCHEMES``, or absolute local paths.  Names are asked for as often as they stand in ``files``.
    """
    names = [c for c in files.columns if c != "size"]
    at = names.index(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris = batch.column(at).to_pylist()
            found = [None if uri is None else _size(uri if ":" in uri.partition("/")[0] else f"file:{uri}") for uri in uris]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*names, "size"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.select(*names).schema.fields)
    return files.select(*names).mapInArrow(run, f"{kinds}, size long")


def _size(uri: str) -> int | None:
    system, path = open_uri(uri)
    info = system.get_file_info(path)
    return info.size if info.type == arrow_fs.FileType.File else None


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files of folders with their size, and folders in them without one; a file is its own only entry."""
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            system, path = open_uri(uri)
            own = system.get_file_info(path)
            if own.type == arrow_fs.FileType.File:
                found = [(uri, own.base_name, own.size)]
            else:
                inside = system.get_file_info(arrow_fs.FileSelector(path))
                found = [
                    (f"{uri.rstrip('/')}/{e.base_name}", e.base_name, e.size if e.type == arrow_fs.FileType.File else None)
                    for e in inside
                    if not e.base_name.startswith(("_", "."))
                ]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["uri", "name", "size"])


def _indexed_files(spark: SparkSession, root: str, pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(F.col("path").alias("file"), F.col("length").alias("size"))
