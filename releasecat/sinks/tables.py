"""Parquet tables under a fixed schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import fs
from ..schemas import COLLECTIONS, DATASTORE, DimensionSpec, as_nullable, conform


def write_table(df: DataFrame, path: str, schema: T.StructType, mode: str = "errorifexists") -> None:
    """Write under ``schema`` with files of even size, whatever the input partitions are."""
    conform(df, schema).hint("rebalance").write.mode(mode).option("compression", "zstd").parquet(path)


def write_sorted(df: DataFrame, path: str, schema: T.StructType, *order: str, mode: str = "errorifexists") -> None:
    """Write in a total order.  The last columns should tell rows apart, so that a hot value can be cut."""
    conform(df, schema).orderBy(*order).write.mode(mode).option("compression", "zstd").parquet(path)


def write_datastore(df: DataFrame, path: str) -> None:
    write_table(df, path, DATASTORE)


def write_collections(df: DataFrame, path: str) -> None:
    write_table(df, path, COLLECTIONS)


def write_dimension(df: DataFrame, path: str, spec: DimensionSpec, name: str) -> None:
    """Write records as the tasks that read them have them: tables of a catalog are read in even splits."""
    conform(df, spec.record_schema(name)).write.option("compression", "zstd").parquet(path)


def write_by_type(
    df: DataFrame,
    schema: T.StructType,
    targets: Mapping[str, str],
    order: tuple[str, ...] = (),
    spread: bool = True,
) -> None:
    """Write one table for each dataset type, all types in one job.

    ``targets`` maps each type to the path of its table.  The job writes a
    partitioned table in the shared folder; its partitions are then renamed.  A
    type without rows gets an empty table.  Rebalancing cuts a type that is too
    large for one task and an order is kept inside each file.  Without ``spread``
    each task writes the rows it has, a file for each of its types: for rows that
    lie in even partitions already and have few types or are stored by type.
    """
    spark = df.sparkSession
    first_target = next(iter(targets.values()))
    staged = f"{first_target}.__parts"
    typed = T.StructType([T.StructField("dataset_type", T.StringType()), *schema.fields])
    rows = conform(df.where(df["dataset_type"].isin(list(targets))), typed)
    if order:
        rows = rows.repartitionByRange("dataset_type", *order).sortWithinPartitions("dataset_type", *order)
    elif spread:
        rows = rows.hint("rebalance", "dataset_type")
    rows.write.mode("overwrite").partitionBy("dataset_type").option("compression", "zstd").parquet(staged)
    written = {n for n in fs.list_names(spark, staged) if n.startswith("dataset_type=")}
    for name, path in targets.items():
        part = fs.partition_name(spark, "dataset_type", name)
        if part in written:
            fs.rename(spark, f"{staged}/{part}", path)
            written.remove(part)
        else:
            write_empty(spark, path, schema)
    if written:
        raise OSError(f"Rows of {sorted(written)} are left in {staged}")
    fs.delete(spark, staged)


def write_empty(spark: SparkSession, path: str, schema: T.StructType, mode: str = "errorifexists") -> None:
    """A table with columns and no rows."""
    spark.createDataFrame([], as_nullable(schema)).coalesce(1).write.mode(mode).parquet(path)
