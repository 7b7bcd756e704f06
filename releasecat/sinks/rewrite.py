"""Rewrites of stored tables: one by one through a staged copy, or many of a dump by one switch of its manifest."""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import fs
from ..schemas import as_nullable, conform
from ..session import run_together
from ..sources.release import MANIFEST_FILE, Release

_STAGED = ".__staged"
_REPLACED = ".__replaced"
# Folder of a dump with tables that a rewrite has made, a numbered one for each rewrite.
VERSIONS = "versions"
_REPLACED_FILES = "replaced.json"
_TYPE_FILES = ("dataset_export_file", "datastore_export_file", "association_export_file")

Rewrite = Callable[[DataFrame], DataFrame]


def rewrite_table(spark: SparkSession, path: str, function: Rewrite, schema: T.StructType) -> None:
    """Replace a table by a function of itself; the schema stays as it is."""
    rewrite_tables(spark, {path: (function, schema)})


def rewrite_tables(spark: SparkSession, changes: Mapping[str, tuple[Rewrite, T.StructType]]) -> None:
    """Rewrite several tables that may be computed from one another.

    Every new table is written beside the old one first, while all old ones are
    still in place, and only then are they swapped in.  A path a plan reads is
    never overwritten.  ``recover_table`` repairs a swap that was cut short.
    """
    for path in changes:
        recover_table(spark, path)
    run_together([partial(_write, spark, path, path + _STAGED, *change) for path, change in changes.items()])
    for path in changes:
        fs.rename(spark, path, path + _REPLACED)
        fs.rename(spark, path + _STAGED, path)
        fs.delete(spark, path + _REPLACED)


def _write(spark: SparkSession, path: str, target: str, function: Rewrite, schema: T.StructType) -> None:
    source = spark.read.schema(as_nullable(schema)).parquet(path)
    result = conform(function(source), schema)
    result.write.mode("overwrite").option("compression", "zstd").parquet(target)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that did not run to its end."""
    if not fs.exists(spark, path + _REPLACED):
        return
    if fs.exists(spark, path):
        fs.delete(spark, path + _REPLACED)
    else:
        fs.rename(spark, path + _REPLACED, path)


def recover_release(release: Release) -> None:
    """Repair every table of a dump; call it before anything of the dump is read."""
    for path in release.all_paths():
        recover_table(release.spark, path)


def rewrite_release(release: Release, changes: Mapping[str, tuple[Rewrite, T.StructType]]) -> None:
    """Rewrite several tables of a dump, named as the manifest names them, so that all change at once.

    The new tables are written into a version folder of their own.  Then one replacement of the manifest makes all
    of them current: whoever reads the manifest sees all old tables or all new ones, and who has read it before
    still has the old ones.  A rewrite that is cut short changes nothing.  One rewrite may run at a time.
    ``remove_replaced`` deletes what is no longer current.
    """
    if not changes:
        return
    spark = release.spark
    folder = f"{VERSIONS}/{_next_version(release):06d}"
    moved = {file: posixpath.join(folder, re.sub(rf"^{VERSIONS}/\d+/", "", file)) for file in changes}
    run_together([
        partial(_write, spark, release.path_of(file), release.path_of(moved[file]), *change)
        for file, change in changes.items()
    ])
    fs.write_text(spark, f"{release.directory}/{folder}/{_REPLACED_FILES}", json.dumps(sorted(changes)))
    path = f"{release.directory}/{MANIFEST_FILE}"
    manifest = _with_files(json.loads(fs.read_text(spark, path)), moved)
    fs.replace_text(spark, path, json.dumps(manifest, indent=2))
    release.refresh()


def remove_replaced(release: Release) -> None:
    """Delete tables that rewrites have replaced and what rewrites that were cut short have left.

    Call it when nobody reads the dump by an earlier manifest any more.
    """
    spark = release.spark
    release.refresh()
    named = {path.removeprefix(f"{release.directory}/") for path in release.all_paths()}
    for version in _versions(release):
        folder = f"{VERSIONS}/{version}"
        listed = f"{release.directory}/{folder}/{_REPLACED_FILES}"
        # Without the list the rewrite was cut short and its tables were never current.
        replaced = json.loads(fs.read_text(spark, listed)) if fs.exists(spark, listed) else []
        for file in set(replaced) - named:
            fs.delete(spark, release.path_of(file))
        if not any(file.startswith(f"{folder}/") for file in named):
            fs.delete(spark, f"{release.directory}/{folder}")


def _versions(release: Release) -> list[str]:
    folder = f"{release.directory}/{VERSIONS}"
    return sorted(fs.list_names(release.spark, folder)) if fs.exists(release.spark, folder) else []


def _next_version(release: Release) -> int:
    return max((int(name) for name in _versions(release) if name.isdigit()), default=0) + 1


def _with_files(manifest: dict, moved: Mapping[str, str]) -> dict:
    def current(file: str) -> str:
        return moved.get(file, file)

    return {
        **manifest,
        "collection_export_file": current(manifest["collection_export_file"]),
        "dimension_record_files": {n: current(f) for n, f in manifest["dimension_record_files"].items()},
        "datasets": [{**e, **{kind: current(e[kind]) for kind in _TYPE_FILES if kind in e}} for e in manifest["datasets"]],
    }
