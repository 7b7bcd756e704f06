"""Catalog tables that a release is exported from."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STANDARD_SPEC, DimensionSpec


@dataclass(frozen=True)
class Catalog:
    """The tables of a catalog.

    dataset_types
        ``name``, ``storageClass``, ``dimensions``, ``parentStorageClass``, ``isCalibration``.
    datasets
        ``dataset_id``, ``dataset_type``, ``run`` and a column for each dimension in use, NULL
        where a type does not have it.
    collections
        ``name``, ``type``, ``doc``, ``children``.
    memberships
        ``dataset_id``, ``collection``, ``timespan`` of tagged and calibration collections.
    datastore
        File records.
    dimensions
        Record table of each dimension element.
    roots
        Root URI of each datastore, for relative paths.
    """

    dataset_types: DataFrame
    datasets: DataFrame
    collections: DataFrame
    memberships: DataFrame
    datastore: DataFrame
    dimensions: Mapping[str, DataFrame] = field(default_factory=dict)
    roots: Mapping[str, str] = field(default_factory=dict)
    spec: DimensionSpec = STANDARD_SPEC
    dimension_config: str = ""


def read_catalog(
    spark: SparkSession,
    directory: str,
    roots: Mapping[str, str] | None = None,
    spec: DimensionSpec = STANDARD_SPEC,
    dimension_config: str = "",
    dimensions: list[str] | None = None,
) -> Catalog:
    """Catalog kept as Parquet tables ``<name>`` and ``dimensions/<element>`` in a directory."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{directory}/{name}")

    elements = [d.name for d in spec.stored()] if dimensions is None else dimensions
    return Catalog(
        dataset_types=table("dataset_types"),
        datasets=table("datasets"),
        collections=table("collections"),
        memberships=table("memberships"),
        datastore=table("datastore"),
        dimensions={
            name: spark.read.schema(spec.record_schema(name)).parquet(f"{directory}/dimensions/{name}")
            for name in elements
        },
        roots=roots or {},
        spec=spec,
        dimension_config=dimension_config,
    )


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """One catalog table over JDBC, read in ranges of a numeric, date or timestamp column."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )
