"""Progress of a running load, from the event files it writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fs
from ..operators.progress import fold_progress
from ..schemas import PROGRESS_EVENTS
from ..session import staging_path


def read_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of progress events from a folder of Parquet files."""
    reader = spark.readStream.schema(PROGRESS_EVENTS)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


# After so many triggers, the changes that a table keeps one after another are made one.
CHANGES = 16


def write_progress(events: DataFrame, target: str, checkpoint: str | None = None, by_type: bool = True) -> StreamingQuery:
    """Keep a Parquet table of the folded progress up to date with the events there are now; see ``read_progress``.

    The state has one row for each dataset type, so it needs no watermark.  A trigger gives the types whose events it
    brought; the table has a partition for each type, and only those of these types are replaced.  A trigger that runs
    again after a failure replaces the same partitions by the same rows.

    A folder for each type is too much for many thousands of them.  Without ``by_type`` a trigger writes the types it
    changed into one folder of its own, a version of the table, and the last row of a type counts.  One table is either
    of one kind or of the other.
    """
    spark = events.sparkSession
    location = checkpoint or staging_path(spark, "progress")

    def replace_types(batch: DataFrame, _batch_id: int) -> None:
        writer = batch.repartition("dataset_type").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("dataset_type").parquet(target)

    def add_version(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % CHANGES == 0:
            _join_versions(spark, target, 2 * batch_id)
        batch.hint("rebalance").write.mode("overwrite").parquet(_version(target, 2 * batch_id + 1))

    return (
        fold_progress(events)
        .writeStream.outputMode("update")
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .foreachBatch(replace_types if by_type else add_version)
        .start()
    )


_VERSIONED = "total long, imported long, status string, dataset_type string, version long"


def _version(target: str, number: int) -> str:
    return f"{target}/version={number}"


def _join_versions(spark: SparkSession, target: str, number: int) -> None:
    """Make all versions before ``number`` one of that number.  It appears whole, and only then the others go; a call
    that was cut short can be repeated."""
    joined = _version(target, number)
    names = [name for name in fs.list_names(spark, target) if name.startswith("version=")]
    earlier = [f"{target}/{name}" for name in names if int(name.removeprefix("version=")) < number]
    if not fs.exists(spark, joined):
        written = f"{target}/_joined-{uuid.uuid4().hex}"
        table = spark.read.option("basePath", target).schema(_VERSIONED).parquet(*earlier)
        _latest(table).hint("rebalance").write.parquet(written)
        fs.rename(spark, written, joined)
    for path in earlier:
        fs.delete(spark, path)


def _latest(table: DataFrame) -> DataFrame:
    row = F.max_by(F.struct("total", "imported", "status"), "version").alias("row")
    return table.groupBy("dataset_type").agg(row).select("dataset_type", "row.*")


def read_progress(spark: SparkSession, target: str) -> DataFrame:
    """The folded progress as it is now: ``dataset_type, total, imported, status``."""
    # A schema of its own keeps names of types that look like numbers or dates as they are.
    if any(name.startswith("version=") for name in fs.list_names(spark, target)):
        return _latest(spark.read.schema(_VERSIONED).parquet(target))
    table = spark.read.schema("total long, imported long, status string, dataset_type string").parquet(target)
    return table.select("dataset_type", "total", "imported", "status")
