"""A release dump: ``manifest.json`` and the Parquet tables it lists."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..operators.selection import resolve_names, union_by_name
from ..operators.validation import paths_outside
from ..schemas import COLLECTIONS, DATASTORE, MANIFEST, STANDARD_SPEC, DimensionSpec, as_nullable

MANIFEST_FILE = "manifest.json"


def read_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """The manifest as one row."""
    return spark.read.schema(MANIFEST).option("multiLine", "true").json(f"{directory}/{MANIFEST_FILE}")


def manifest_types(manifest: DataFrame) -> DataFrame:
    """One row for each dataset type, in manifest order, with its three files."""
    return manifest.select(F.posexplode("datasets").alias("position", "entry")).select(
        "position",
        "entry.dataset_type.*",
        "entry.dataset_export_file",
        "entry.datastore_export_file",
        "entry.association_export_file",
    )


def manifest_dimensions(manifest: DataFrame) -> DataFrame:
    """One row for each dimension element with its file."""
    return manifest.select(F.explode("dimension_record_files").alias("dimension", "file"))


def manifest_files(manifest: DataFrame) -> DataFrame:
    """Every file the manifest names."""
    types = manifest_types(manifest)
    files = [
        manifest.select(F.col("collection_export_file").alias("file")),
        manifest_dimensions(manifest).select("file"),
        *[types.select(F.col(f"{kind}_export_file").alias("file")) for kind in ("dataset", "datastore", "association")],
    ]
    return reduce(DataFrame.unionByName, files)


@dataclass(frozen=True)
class Release:
    """Lazily read tables of a dump.

    Only the manifest, whose size is that of the list of dataset types, is held
    by the driver.  All scans have an explicit schema: a UUID column cannot be
    inferred from the files.
    """

    spark: SparkSession
    directory: str
    spec: DimensionSpec = STANDARD_SPEC
    subset: tuple[str, ...] | None = None

    @cached_property
    def manifest(self) -> DataFrame:
        return read_manifest(self.spark, self.directory)

    def refresh(self) -> None:
        """Forget the manifest, so that the next read sees the current one."""
        for name in ("manifest", "header", "type_table", "types"):
            self.__dict__.pop(name, None)

    @cached_property
    def header(self) -> Row:
        """Collection file, dimension configuration and dimension files."""
        return self.manifest.drop("datasets").first()

    @cached_property
    def type_table(self) -> DataFrame:
        """Dataset types of this release or of the chosen subset, in manifest order."""
        types = manifest_types(self.manifest)
        return types if self.subset is None else resolve_names(types, self.subset)

    @cached_property
    def types(self) -> list[Row]:
        return self.type_table.orderBy("position").collect()

    def select(self, globs: Iterable[str] | None) -> Release:
        """The same dump limited to dataset types by names and globs."""
        return self if globs is None else replace(self, subset=tuple(globs))

    def type_named(self, name: str) -> Row:
        for row in self.types:
            if row["name"] == name:
                return row
        raise KeyError(f"Dataset type {name!r} is not in the dump")

    def path_of(self, file: str) -> str:
        """Absolute path of a file of the dump; a name that leads outside is an error."""
        inside = posixpath.normpath(posixpath.join("/", file)).lstrip("/")
        if file.startswith("/") or posixpath.normpath(file) != inside or inside in ("", "."):
            raise ValueError(f"Path {file!r} is outside the release directory")
        return f"{self.directory}/{file}"

    def outside_files(self) -> DataFrame:
        """Files of the manifest that lead outside the dump."""
        return paths_outside(manifest_files(self.manifest))

    def dimension_path(self, name: str) -> str:
        return self.path_of(self.dimension_files[name])

    @property
    def dimension_files(self) -> dict[str, str]:
        return self.header["dimension_record_files"]

    def _scan(self, file: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(as_nullable(schema)).parquet(self.path_of(file))

    def all_paths(self) -> list[str]:
        """Paths of all tables the manifest names."""
        kinds = ("dataset_export_file", "datastore_export_file", "association_export_file")
        files = [self.header["collection_export_file"], *self.dimension_files.values()]
        return [self.path_of(file) for file in [*files, *[row[kind] for row in self.types for kind in kinds]]]

    def read_datasets(self, name: str) -> DataFrame:
        """Datasets of one type."""
        row = self.type_named(name)
        return self._scan(row["dataset_export_file"], self.spec.dataset_schema(row["dimensions"]))

    def read_dataset_ids(self, name: str) -> DataFrame:
        """Only the ids of the datasets of one type; the scan reads no other column."""
        return self.read_datasets(name).select("dataset_id")

    def read_associations(self, name: str) -> DataFrame:
        row = self.type_named(name)
        return self._scan(row["association_export_file"], self.spec.association_schema(row["dimensions"]))

    def read_datastore(self, name: str) -> DataFrame:
        return self._scan(self.type_named(name)["datastore_export_file"], DATASTORE)

    def read_collections(self) -> DataFrame:
        return self._scan(self.header["collection_export_file"], COLLECTIONS)

    def read_dimension(self, name: str) -> DataFrame:
        """Records of one dimension element; an unknown name is a KeyError."""
        return self._scan(self.dimension_files[name], self.spec.record_schema(name))

    def read_all_datasets(self, types: Sequence[str] | None = None) -> DataFrame:
        """All datasets as one table with ``dataset_type``; absent dimensions are NULL."""
        return self._all("dataset", types, self.spec.dataset_schema)

    def read_all_datastore(self, types: Sequence[str] | None = None) -> DataFrame:
        return self._all("datastore", types, lambda _: DATASTORE)

    def read_all_associations(self, types: Sequence[str] | None = None) -> DataFrame:
        return self._all("association", types, self.spec.association_schema)

    def _all(self, kind: str, types: Sequence[str] | None, schema_of: Callable[[Sequence[str]], T.StructType]) -> DataFrame:
        """Tables of one kind of all types: one scan for each schema, with the type told by the file a row is in."""
        names = [row["name"] for row in self.types] if types is None else types
        if not names:
            empty = T.StructType([*as_nullable(schema_of(())).fields, T.StructField("dataset_type", T.StringType())])
            return self.spark.createDataFrame([], empty)
        rows = {row["name"]: row for row in self.types}
        groups: dict[str, tuple[T.StructType, dict[str, list[str]]]] = {}
        for name in dict.fromkeys(names):
            schema = as_nullable(schema_of(self.type_named(name)["dimensions"]))
            _, files = groups.setdefault(schema.json(), (schema, {}))
            files.setdefault(rows[name][f"{kind}_export_file"], []).append(name)
        return union_by_name([self._typed_scan(schema, files) for schema, files in groups.values()])

    def _typed_scan(self, schema: T.StructType, files: Mapping[str, Sequence[str]]) -> DataFrame:
        paths = {file: self.path_of(file) for file in files}
        scan = self.spark.read.schema(schema).parquet(*paths.values())
        if len(files) == 1 and len(next(iter(files.values()))) == 1:
            return scan.withColumn("dataset_type", F.lit(next(iter(files.values()))[0]))
        # One row for each file, as in the scan's own index, which the driver holds: whose table it is is found once for
        # a file and not from the path of every row.  A table is a file or a folder of part files.
        tables = {fs.qualified(self.spark, paths[file]): names for file, names in files.items()}
        owner = self.spark.createDataFrame(
            [(form, name) for uri in scan.inputFiles() for name in _owners(uri, tables) for form in _forms(uri)],
            "__uri string, dataset_type string",
        )
        known = scan.select("*", F.col("_metadata.file_path").alias("__file"))
        typed = known.join(F.broadcast(owner), F.col("__file") == F.col("__uri"), "left")
        return typed.select(*schema.names, "dataset_type")


def _forms(uri: str) -> set[str]:
    """A local file has one slash in the paths that a scan tells and three in its index."""
    return {re.sub("^file:/+", start, uri) for start in ("file:/", "file:///")}


def _owners(uri: str, tables: Mapping[str, Sequence[str]]) -> Sequence[str]:
    """Dataset types of the table that a file, given by its encoded URI, is or lies in."""
    location = unquote(re.sub("^file:/+", "file:///", uri))
    return tables.get(location) or tables.get(posixpath.dirname(location), ())
