"""Writer of ``manifest.json``."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from .. import fs
from ..operators.selection import patch_where
from ..sources.release import MANIFEST_FILE, Release


def type_entry(row: Row) -> dict:
    """Manifest entry of one dataset type."""
    return {
        "dataset_type": {
            "name": row["name"],
            "storageClass": row["storageClass"],
            "dimensions": list(row["dimensions"]),
            "parentStorageClass": row["parentStorageClass"],
            "isCalibration": bool(row["isCalibration"]),
        },
        "dataset_export_file": f"{row['name']}.datasets.parquet",
        "datastore_export_file": f"{row['name']}.datastore.parquet",
        "association_export_file": f"{row['name']}.association.parquet",
    }


def write_manifest(
    spark: SparkSession,
    directory: str,
    collection_file: str,
    dimension_config: str,
    dimension_files: Mapping[str, str],
    entries: Sequence[dict],
) -> None:
    """Write the manifest.  It names files and dataset types and is small however large the release is."""
    content = {
        "collection_export_file": collection_file,
        "dimension_config": dimension_config,
        "dimension_record_files": dict(dimension_files),
        "datasets": list(entries),
    }
    fs.replace_text(spark, f"{directory}/{MANIFEST_FILE}", json.dumps(content, indent=2))


def patch_storage_class(types: DataFrame, names: Sequence[str], storage_class: str) -> DataFrame:
    """Dataset types with another storage class for some of them."""
    return patch_where(types, "name", names, "storageClass", storage_class)


def rewrite_types(release: Release, types: DataFrame) -> None:
    """Write the manifest again with changed dataset types; all else stays."""
    rows = types.orderBy("position").collect()
    kept_files = ("dataset_export_file", "datastore_export_file", "association_export_file")
    entries = [{**type_entry(row), **{f: row[f] for f in kept_files}} for row in rows]
    write_manifest(
        release.spark,
        release.directory,
        release.header["collection_export_file"],
        release.header["dimension_config"],
        release.header["dimension_record_files"],
        entries,
    )
