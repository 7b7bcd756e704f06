"""Pruning of records that no dataset of the release refers to."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from .joins import key_set, keep_matching, keep_matching_all, keep_matching_any, orphans, other_side
from .ordering import sort_by
from .selection import drop_value

_VISIT = ["instrument", "visit"]
_EXPOSURE = ["instrument", "exposure"]


@dataclass(frozen=True)
class ReferencedKeys:
    """Distinct (instrument, visit) and (instrument, exposure) that datasets lead to."""

    visits: DataFrame
    exposures: DataFrame


def referenced_keys(datasets: DataFrame, definition: DataFrame) -> ReferencedKeys:
    """Keys in data IDs, and those one step away through the definition table.

    One step only: a visit found through an exposure does not bring in its
    other exposures.
    """
    visits = key_set(datasets, _VISIT)
    exposures = key_set(datasets, _EXPOSURE)
    return ReferencedKeys(
        visits=visits.union(other_side(definition, exposures, _EXPOSURE, _VISIT)).distinct(),
        exposures=exposures.union(other_side(definition, visits, _VISIT, _EXPOSURE)).distinct(),
    )


def prune_exposures(exposures: DataFrame, keys: ReferencedKeys) -> DataFrame:
    kept = keep_matching(exposures, keys.exposures, {"instrument": "instrument", "id": "exposure"}, unique_keys=True)
    return _in_order(kept, "instrument", "id")


def prune_visits(visits: DataFrame, keys: ReferencedKeys) -> DataFrame:
    kept = keep_matching(visits, keys.visits, {"instrument": "instrument", "id": "visit"}, unique_keys=True)
    return _in_order(kept, "instrument", "id")


def prune_visit_members(members: DataFrame, keys: ReferencedKeys) -> DataFrame:
    """For tables keyed by visit and something else: regions, memberships."""
    return _in_order(keep_matching(members, keys.visits, _VISIT, unique_keys=True), *_VISIT)


def prune_definitions(definition: DataFrame, keys: ReferencedKeys) -> DataFrame:
    """Distinct definition rows with a referenced exposure or a referenced visit."""
    return _in_order(keep_matching_any(definition, (keys.exposures, _EXPOSURE), (keys.visits, _VISIT)), *_VISIT)


def prune_unreferenced(tables: Mapping[str, DataFrame], keys: ReferencedKeys) -> dict[str, DataFrame]:
    """Pruned form of every dimension table that is keyed by visit or exposure."""
    rules = {
        "exposure": prune_exposures,
        "visit": prune_visits,
        "visit_detector_region": prune_visit_members,
        "visit_system_membership": prune_visit_members,
        "visit_definition": prune_definitions,
    }
    return {name: rules[name](table, keys) for name, table in tables.items() if name in rules}


def _in_order(table: DataFrame, *first: str) -> DataFrame:
    # The columns after the key only break ties, so that the rows of one key can be cut into ranges.
    ties = [c for c, kind in table.dtypes if c not in first and kind in ("bigint", "int", "string")]
    return sort_by(table, *first, *ties)


def remove_value(
    records: Mapping[str, tuple[DataFrame, str]],
    datasets: DataFrame,
    dependents: Mapping[str, DataFrame],
    dataset_column: str,
    value: object,
) -> tuple[dict[str, DataFrame], DataFrame, dict[str, DataFrame]]:
    """Remove one dimension value everywhere.

    ``records`` maps a table to itself and the column that holds the value.
    Datasets with the value go, and with them the rows of ``dependents`` that
    share their ``dataset_id``.
    """
    kept_records = {name: drop_value(table, column, value) for name, (table, column) in records.items()}
    kept_datasets = drop_value(datasets, dataset_column, value)
    ids = kept_datasets.select("dataset_id")
    return kept_records, kept_datasets, keep_matching_all(dependents, ids, "dataset_id", unique_keys=True)


def dangling_definitions(definition: DataFrame, exposures: DataFrame) -> DataFrame:
    """Definition rows whose exposure record was pruned: the other exposures of a referenced visit."""
    return orphans(definition, exposures, {"instrument": "instrument", "exposure": "id"})
