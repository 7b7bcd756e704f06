"""Export of a release from catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .. import fs
from ..functions.identifiers import or_unbounded
from ..operators.collections import association_collections, flatten_collections
from ..operators.joins import keep_matching, keep_missing, shuffled
from ..operators.paths import make_paths_absolute
from ..operators.search import associations, extra_runs, find_first, search, search_all
from ..operators.selection import resolve_names
from ..operators.validation import require_none
from ..schemas import COLLECTIONS, DATASTORE, RUN, as_nullable, by_dimensions
from ..sinks.manifest import type_entry, write_manifest
from ..session import FEW, cut_lineage, run_together, side_by_side
from ..sinks.tables import write_by_type, write_collections, write_dimension
from ..sources.catalog import Catalog
from ..sources.release import Release

COLLECTIONS_FILE = "collections.parquet"


@dataclass(frozen=True)
class Selection:
    """What a release consists of, before it is written."""

    types: list[Row]
    datasets: DataFrame
    collections: DataFrame
    memberships: DataFrame


def select_datasets(
    catalog: Catalog, types: Sequence[Row], collections: DataFrame, all_versions: bool = False
) -> DataFrame:
    """Datasets of the given types reached through the collections.

    Calibration types keep every version; the others keep the first one for
    each data ID.  All types are searched in one plan.
    """
    keep_all = [t["name"] for t in types if all_versions or t["isCalibration"]]
    first_only = [t["name"] for t in types if t["name"] not in keep_all]
    of_type = F.col("dataset_type")
    dimensions = [c for c in catalog.datasets.columns if c not in ("dataset_id", "dataset_type", "run")]
    candidates = search(catalog.datasets.where(of_type.isin(first_only)), catalog.memberships, collections)
    best = find_first(candidates, ["dataset_type", *dimensions]).select(*catalog.datasets.columns)
    if not keep_all:
        return best
    everything = search_all(catalog.datasets.where(of_type.isin(keep_all)), catalog.memberships, collections)
    return best.unionByName(everything) if first_only else everything


def select_release(
    catalog: Catalog, types: Sequence[str], provenance_types: Sequence[str], collections: Sequence[str]
) -> Selection:
    """Search the collections, then take provenance from every run that was found."""
    chosen = resolve_names(catalog.dataset_types, types).orderBy("name").collect()
    provenance = resolve_names(catalog.dataset_types, provenance_types).orderBy("name").collect()
    catalog, resolved = store_searched(catalog, [t["name"] for t in [*chosen, *provenance]], collections)
    with side_by_side(catalog.datasets.sparkSession, len(chosen)):
        found = cut_lineage(select_datasets(catalog, chosen, resolved), "datasets", "dataset_type")
    runs = extra_runs(found, resolved)
    added = keep_matching(
        catalog.collections.where(F.col("type") == RUN), runs, {"name": "run"}, unique_keys=True
    ).withColumn("search_rank", F.lit(None).cast("long"))
    referenced = cut_lineage(resolved.unionByName(added), "referenced")
    if provenance:
        known = select_datasets(catalog, provenance, referenced, all_versions=True)
        already = keep_missing(known, shuffled(found), "dataset_id", unique_keys=True)
        found = found.unionByName(cut_lineage(already, "provenance", "dataset_type"))
    names = {t["name"] for t in chosen}
    return Selection([*chosen, *[t for t in provenance if t["name"] not in names]], found, referenced, catalog.memberships)


def store_searched(catalog: Catalog, types: Sequence[str], collections: Sequence[str]) -> tuple[Catalog, DataFrame]:
    """The catalog as far as a search for these types reads it, and the resolved collections.

    Every search reads datasets and memberships more than once.  They are stored
    with the rows that can be found, so that their sources are read once.
    """

    def resolve() -> tuple[DataFrame, DataFrame, DataFrame]:
        known = cut_lineage(catalog.collections, "known-collections")
        resolved = flatten_collections(known, collections)
        searched = association_collections(resolved)
        reached = keep_matching(catalog.memberships, searched, {"collection": "name"}, unique_keys=True).select(
            "dataset_id", "collection", "timespan"
        )
        return known, resolved, cut_lineage(reached, "memberships")

    wanted = catalog.datasets.where(F.col("dataset_type").isin(list(types)))
    (known, resolved, memberships), datasets = run_together([resolve, partial(cut_lineage, wanted, "wanted")])
    return replace(catalog, collections=known, memberships=memberships, datasets=datasets), resolved


def datastore_for(datasets: DataFrame, datastore: DataFrame) -> DataFrame:
    """File records of the datasets, with their dataset type."""
    return datastore.join(datasets.select("dataset_id", "dataset_type"), "dataset_id")


def export_release(
    catalog: Catalog,
    directory: str,
    types: Sequence[str],
    provenance_types: Sequence[str] = (),
    collections: Sequence[str] = (),
    absolute_paths: bool = True,
) -> Release:
    """Write a release dump and return it.

    Tables of dataset types with the same dimensions are written by one job.
    The manifest comes last, after all checks: a directory without one is an
    unfinished export.
    """
    spark = catalog.datasets.sparkSession
    selection = select_release(catalog, types, provenance_types, collections)
    fs.make_directory(spark, directory)

    dimension_files = {n: f"{n}.dimension.parquet" for n in catalog.dimensions if catalog.spec[n].has_own_table}
    jobs = [
        partial(write_dimension, catalog.dimensions[name], f"{directory}/{file}", catalog.spec, name)
        for name, file in dimension_files.items()
    ]

    entries = [type_entry(t) for t in selection.types]
    files = {e["dataset_type"]["name"]: e for e in entries}
    with side_by_side(spark, len(files)):
        entries_found = cut_lineage(
            associations(selection.datasets, selection.memberships, selection.collections).withColumn(
                "timespan", or_unbounded("timespan")
            ),
            "associations",
            "dataset_type",
        )
    for dimensions, names in by_dimensions(selection.types).items():
        jobs.append(
            partial(
                write_by_type,
                selection.datasets,
                catalog.spec.dataset_schema(dimensions),
                {n: f"{directory}/{files[n]['dataset_export_file']}" for n in names},
                spread=False,
            )
        )
        jobs.append(
            partial(
                write_by_type,
                entries_found,
                catalog.spec.association_schema(dimensions),
                {n: f"{directory}/{files[n]['association_export_file']}" for n in names},
                order=("collection", "dataset_id"),
            )
        )

    records = datastore_for(selection.datasets, catalog.datastore)
    if absolute_paths:
        records = make_paths_absolute(records, catalog.roots)
    record_files = {n: f"{directory}/{e['datastore_export_file']}" for n, e in files.items()}
    collection_rows = selection.collections.select(*COLLECTIONS.names)
    # A task that joins records of few types writes a file for each of them; they are not shuffled again.
    jobs.append(partial(write_by_type, records, DATASTORE, record_files, spread=len(record_files) > FEW))
    jobs.append(partial(write_collections, collection_rows, f"{directory}/{COLLECTIONS_FILE}"))
    with side_by_side(spark, len(record_files)):
        run_together(jobs)
    # A path without a known root came out NULL.  Column statistics let the scan skip what has none.
    written = spark.read.schema(as_nullable(DATASTORE)).parquet(*record_files.values())
    require_none(written.where(F.col("path").isNull()).select("datastore_name"), "Relative paths in a datastore without a root")
    write_manifest(spark, directory, COLLECTIONS_FILE, catalog.dimension_config, dimension_files, entries)
    return Release(spark, directory, catalog.spec)
