"""Dataset search over a list of collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..schemas import RUN
from .collections import association_collections, search_collections
from .joins import keep_matching, keep_missing


def search(datasets: DataFrame, memberships: DataFrame, collections: DataFrame) -> DataFrame:
    """Every way a dataset is reached: through its run, a tag or a calibration.

    ``memberships`` holds ``dataset_id``, ``collection`` and ``timespan``;
    ``collections`` holds ``name``, ``type`` and ``search_rank``.
    """
    runs = collections.where(F.col("type") == RUN).select(F.col("name").alias("run"), "search_rank")
    through_run = datasets.join(runs, "run").select(
        *datasets.columns,
        F.col("run").alias("collection"),
        F.lit(None).cast(memberships.schema["timespan"].dataType).alias("timespan"),
        "search_rank",
    )
    places = association_collections(collections).select(F.col("name").alias("collection"), "search_rank")
    through_membership = datasets.join(
        memberships.join(places, "collection").select("dataset_id", "collection", "timespan", "search_rank"),
        "dataset_id",
    ).select(*datasets.columns, "collection", "timespan", "search_rank")
    return through_run.unionByName(through_membership)


def find_first(
    candidates: DataFrame, keys: Sequence[str], rank: Sequence[str] = ("search_rank", "dataset_id")
) -> DataFrame:
    """The dataset of each key that comes first in ``rank``.

    The limit of one row for a key is applied before the shuffle as well, so a
    hot key sends one row from each partition.
    """
    # Numbers first: rows are sorted by the keys, and the first bytes of a number tell more than those of a name.
    numbers = [c for c in keys if isinstance(candidates.schema[c].dataType, IntegralType)]
    window = Window.partitionBy(*numbers, *[c for c in keys if c not in numbers]).orderBy(*[F.col(c).asc_nulls_last() for c in rank])
    return candidates.withColumn("__place", F.row_number().over(window)).where("__place = 1").drop("__place")


def search_all(datasets: DataFrame, memberships: DataFrame, collections: DataFrame) -> DataFrame:
    """Datasets reached in any way, each once and without find-first."""
    searched = search_collections(collections)
    runs = searched.where(F.col("type") == RUN)
    reached = keep_matching(
        memberships, association_collections(searched), {"collection": "name"}, unique_keys=True
    )
    by_run = keep_matching(datasets, runs, {"run": "name"}, unique_keys=True)
    others = keep_missing(datasets, runs, {"run": "name"}, unique_keys=True)
    return by_run.unionByName(keep_matching(others, reached, "dataset_id"))


def associations(datasets: DataFrame, memberships: DataFrame, collections: DataFrame) -> DataFrame:
    """Tag and calibration entries of the given datasets, with the dataset columns."""
    entries = keep_matching(
        memberships, association_collections(collections), {"collection": "name"}, unique_keys=True
    )
    return datasets.join(entries, "dataset_id").select(*datasets.columns, "collection", "timespan")


def runs_found(datasets: DataFrame) -> DataFrame:
    """Runs of the given datasets."""
    return datasets.select("run").distinct()


def extra_runs(datasets: DataFrame, resolved: DataFrame) -> DataFrame:
    """Runs of the datasets found that were not among the collections searched."""
    return keep_missing(runs_found(datasets), resolved, {"run": "name"}, unique_keys=True)
