"""Counts and sizes.

Every report of this module groups in one pass over all dataset types, with
partial sums before each shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.formatting import decimal_size
from ..functions.paths import physical_file
from .joins import fill_sizes
from .selection import with_size, without_size

_BYTES = "decimal(38,0)"


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """Number of rows, as one row."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_files(datastore: DataFrame, *groups: str) -> DataFrame:
    """Distinct physical files; records without a path count as one file."""
    files = datastore.select(*groups, physical_file("path").alias("file")).distinct()
    return files.groupBy(*groups).agg(F.count(F.lit(1)).alias("files"))


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def known_size(datastore: DataFrame, *groups: str) -> DataFrame:
    """Sum of the recorded sizes, once for every record; 0 without any."""
    return datastore.groupBy(*groups).agg(
        F.coalesce(F.sum(F.col("file_size").cast(_BYTES)), F.lit(0)).cast(_BYTES).alias("bytes")
    )


def files_without_size(datastore: DataFrame, *groups: str) -> DataFrame:
    """Distinct files of the records that have no size."""
    return without_size(datastore).select(*groups, physical_file("path").alias("file")).distinct()


def listed_size(datastore: DataFrame, listing: DataFrame, *groups: str) -> DataFrame:
    """Sum of the listed sizes of files without a recorded size, once for every file."""
    sized = fill_sizes(files_without_size(datastore, *groups), listing)
    return sized.groupBy(*groups).agg(
        F.coalesce(F.sum(F.col("size").cast(_BYTES)), F.lit(0)).cast(_BYTES).alias("bytes")
    )


def unlisted_files(datastore: DataFrame, listing: DataFrame, *groups: str) -> DataFrame:
    """Files that have neither a recorded nor a listed size: ``file`` with its groups."""
    return fill_sizes(files_without_size(datastore, *groups), listing).where(F.col("size").isNull()).drop("size")


def release_summary(
    datasets: DataFrame,
    datastore: DataFrame,
    listing: DataFrame | None = None,
    types: DataFrame | None = None,
) -> DataFrame:
    """Datasets, files, bytes and files of unknown size of each dataset type, by name.

    ``files_without_size`` counts the files that neither a record nor the listing gives a size; ``bytes`` is without
    them.  ``types`` (``name``) adds types without datasets and leaves out all others.
    Each part is reduced to one row for a type before the parts are added up.
    """
    unknown = F.count_if(F.col("size").isNull()).alias("files_without_size")
    parts = [
        _part(datasets.groupBy("dataset_type").agg(F.count(F.lit(1)).alias("datasets")), "datasets"),
        # Known sizes go through the same grouping by file that counts the files.
        _part(
            datastore.groupBy("dataset_type", physical_file("path").alias("file"))
            .agg(F.sum("file_size").alias("size"))
            .groupBy("dataset_type")
            .agg(F.count(F.lit(1)).alias("files"), F.sum(F.col("size").cast(_BYTES)).alias("bytes"), unknown),
            "files",
            "bytes",
            *(["files_without_size"] if listing is None else []),
        ),
    ]
    if listing is not None:
        listed = fill_sizes(files_without_size(datastore, "dataset_type"), listing)
        sized = listed.groupBy("dataset_type").agg(F.sum(F.col("size").cast(_BYTES)).alias("bytes"), unknown)
        parts.append(_part(sized, "bytes", "files_without_size"))
    if types is not None:
        parts.append(_part(types.select(F.col("name").alias("dataset_type"), F.lit(1).alias("wanted")), "wanted"))
    table = reduce(DataFrame.unionByName, parts)
    totals = table.groupBy("dataset_type").agg(
        F.sum("datasets").alias("datasets"),
        F.sum("files").alias("files"),
        F.sum("bytes").cast(_BYTES).alias("bytes"),
        F.sum("files_without_size").alias("files_without_size"),
        F.sum("wanted").alias("wanted"),
    )
    if types is not None:
        totals = totals.where("wanted > 0")
    columns = ("dataset_type", "datasets", "files", "bytes", "files_without_size")
    return totals.select(*columns, decimal_size("bytes").alias("size")).orderBy("dataset_type")


def _part(df: DataFrame, *columns: str) -> DataFrame:
    kinds = {"datasets": "bigint", "files": "bigint", "bytes": _BYTES, "files_without_size": "bigint", "wanted": "bigint"}
    return df.select(
        "dataset_type",
        *[
            F.coalesce(F.col(c) if c in columns else F.lit(None), F.lit(0)).cast(kind).alias(c)
            for c, kind in kinds.items()
        ],
    )


def count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table, by name."""
    counts = [_table_rows(name, df) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("name")


def _table_rows(name: str, df: DataFrame) -> DataFrame:
    return count_rows(df, "n_rows").select(F.lit(name).alias("name"), "n_rows")


def footer_count_report(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, StructType | str] | None = None) -> DataFrame:
    """Rows of each Parquet table, by name, from the row counts in the files' footers.

    Only Spark's newer Parquet source hands the count down to the footers, so the tables are opened with it here.
    Known schemas save opening a file of each table before the count.
    """
    sources, pushed = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
    spark.conf.set(pushed, "true")
    before = spark.conf.get(sources)
    spark.conf.set(sources, "")
    try:
        tables = {}
        for name, path in paths.items():
            reader = spark.read if not schemas or name not in schemas else spark.read.schema(schemas[name])
            tables[name] = reader.parquet(path)
        # Added up from footers, a table without rows has no count at all; a row of its own gives it one.
        zeros = spark.createDataFrame([(name, 0) for name in tables], "name string, n_rows long")
        counts = reduce(DataFrame.unionByName, [_table_rows(name, df) for name, df in tables.items()]).unionByName(zeros)
        return counts.groupBy("name").agg(F.sum("n_rows").alias("n_rows")).orderBy("name")
    finally:
        spark.conf.set(sources, before)


def type_count_report(types: DataFrame, datasets: DataFrame, datastore: DataFrame, associations: DataFrame) -> DataFrame:
    """Datasets, file records and associations of each dataset type, by name."""
    tables = {"datasets": datasets, "datastore_records": datastore, "associations": associations}
    parts = [types.select(F.col("name").alias("dataset_type"), *[F.lit(0).cast("long").alias(t) for t in tables])]
    for table, df in tables.items():
        counted = df.groupBy("dataset_type").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            counted.select(
                "dataset_type", *[(F.col("n") if t == table else F.lit(0)).cast("long").alias(t) for t in tables]
            )
        )
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("dataset_type")
        .agg(*[F.sum(t).alias(t) for t in tables])
        .orderBy("dataset_type")
    )


def run_units(datasets: DataFrame) -> DataFrame:
    """One load unit for each type and run, with its number of datasets."""
    return datasets.groupBy("dataset_type", "run").agg(F.count(F.lit(1)).alias("datasets"))


def collection_units(associations: DataFrame, collections: DataFrame) -> DataFrame:
    """One load unit for each collection: its type, entries and how many are valid for ever."""
    counted = associations.groupBy("collection").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(
            F.col("timespan").isNull()
            | (F.col("timespan.begin_nsec").isNull() & F.col("timespan.end_nsec").isNull())
        ).alias("unbounded"),
    )
    kinds = collections.select(F.col("name").alias("collection"), "type")
    return counted.join(kinds, "collection").select("collection", "type", "entries", "unbounded")
