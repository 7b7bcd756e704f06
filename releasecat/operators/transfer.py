"""Transfer planning: pairs of paths, batches and totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import strip_scheme
from .ordering import row_index, running_total
from .paths import map_to_datastores


def transfer_pairs(files: DataFrame, mapping: Mapping[str, str] | DataFrame) -> DataFrame:
    """Source path and destination key for every file."""
    uris = files.select(F.col("file").alias("path"), strip_scheme("file").alias("source"))
    mapped = map_to_datastores(uris, mapping)
    return mapped.select("source", F.concat("datastore_name", F.lit("/"), "path").alias("destination"))


def assign_batches(pairs: DataFrame, size: int, key: str = "source") -> DataFrame:
    """Number the rows in batches of ``size``, in order of ``key``, which must be distinct; only the last is shorter.

    Rows are numbered inside ranges of the key, so no task sees them all.
    """
    placed = row_index(pairs, [key], "__place")
    return placed.withColumn("batch", F.floor(F.col("__place") / F.lit(size)).cast("long")).drop("__place")


def run_transfers(batches: DataFrame, copy: Callable[[str, str], bool]) -> DataFrame:
    """Copy every planned file in the tasks; one result row for each batch.

    ``copy`` takes source and destination and returns whether it sent the file.
    It must skip what is there already: a task that is lost runs again.
    """

    def send(records):
        for record in records:
            counts: dict[int, list[int]] = {}
            for row in record.to_pylist():
                sent = counts.setdefault(row["batch"], [0, 0])
                sent[0 if copy(row["source"], row["destination"]) else 1] += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "batch": pa.array(list(counts), pa.int64()),
                    "uploaded": pa.array([sent[0] for sent in counts.values()], pa.int64()),
                    "skipped": pa.array([sent[1] for sent in counts.values()], pa.int64()),
                }
            )

    work = batches.select("batch", "source", "destination").repartition("batch")
    results = work.mapInArrow(send, "batch long, uploaded long, skipped long")
    return results.groupBy("batch").agg(
        F.sum("uploaded").alias("uploaded"), F.sum("skipped").alias("skipped")
    )


def transfer_totals(results: DataFrame) -> DataFrame:
    """Files sent, files skipped and both together."""
    return results.agg(
        F.coalesce(F.sum("uploaded"), F.lit(0)).alias("uploaded"),
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.col("uploaded") + F.col("skipped")), F.lit(0)).alias("total"),
    )


def running_transfer_totals(results: DataFrame, order: list[str]) -> DataFrame:
    """Files handled up to and including each result, in completion order."""
    return running_total(results, order, F.col("uploaded") + F.col("skipped"), "total")
