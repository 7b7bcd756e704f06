"""Changes to a dump in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import keep_matching
from ..operators.prune import (
    ReferencedKeys,
    prune_definitions,
    prune_exposures,
    prune_visit_members,
    prune_visits,
    referenced_keys,
)
from ..operators.selection import drop_value
from ..schemas import DATASTORE
from ..session import cut_lineage
from ..sinks.manifest import patch_storage_class, rewrite_types
from ..sinks.rewrite import Rewrite, recover_release, rewrite_release
from ..sources.release import Release

_PRUNED = {
    "exposure": prune_exposures,
    "visit": prune_visits,
    "visit_detector_region": prune_visit_members,
    "visit_system_membership": prune_visit_members,
    "visit_definition": prune_definitions,
}


def change_storage_class(release: Release, names: Sequence[str], storage_class: str) -> Release:
    """Set the storage class of some dataset types in the manifest."""
    rewrite_types(release, patch_storage_class(release.type_table, names, storage_class))
    return Release(release.spark, release.directory, release.spec)


def release_keys(release: Release) -> ReferencedKeys:
    """Visits and exposures the datasets of a dump lead to, computed once."""
    datasets = release.read_all_datasets()
    for column, kind in (("instrument", "string"), ("visit", "long"), ("exposure", "long")):
        if column not in datasets.columns:
            datasets = datasets.withColumn(column, F.lit(None).cast(kind))
    keys = referenced_keys(datasets, release.read_dimension("visit_definition"))
    return ReferencedKeys(cut_lineage(keys.visits), cut_lineage(keys.exposures))


def prune_release(release: Release) -> None:
    """Remove visit and exposure records that no dataset of the dump refers to; all tables change at once."""
    recover_release(release)
    keys = release_keys(release)
    changes: dict[str, tuple[Rewrite, object]] = {}
    for name, rule in _PRUNED.items():
        if name in release.dimension_files:
            rewrite = partial(_apply, rule, keys)
            changes[release.dimension_files[name]] = (rewrite, release.spec.record_schema(name))
    rewrite_release(release, changes)


def remove_value_from_release(
    release: Release,
    records: Mapping[str, str],
    dataset_types: Sequence[str],
    dataset_column: str,
    value: object,
) -> None:
    """Remove one dimension value from records and from datasets with all that hangs on them.

    ``records`` maps a dimension element to its column with the value.
    """
    recover_release(release)
    changes: dict[str, tuple[Rewrite, object]] = {}
    for name, column in records.items():
        rewrite = partial(drop_value, column=column, value=value)
        changes[release.dimension_files[name]] = (rewrite, release.spec.record_schema(name))
    for name in dataset_types:
        row = release.type_named(name)
        kept = drop_value(release.read_datasets(name), dataset_column, value).select("dataset_id")
        matching = partial(keep_matching, keys=kept, on="dataset_id", unique_keys=True)
        for file, schema in (
            ("dataset_export_file", release.spec.dataset_schema(row["dimensions"])),
            ("association_export_file", release.spec.association_schema(row["dimensions"])),
            ("datastore_export_file", DATASTORE),
        ):
            changes[row[file]] = (matching, schema)
    rewrite_release(release, changes)


def _apply(rule, keys: ReferencedKeys, table: DataFrame) -> DataFrame:
    return rule(table, keys)
