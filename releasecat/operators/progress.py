"""Progress of a load, folded from its events.  Works on batches and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPLETE = "complete"
WORKING = "working"


def load_events(counts: DataFrame) -> DataFrame:
    """Events of a finished load step, from the rows it wrote for each dataset type (``n_rows``)."""
    none = F.lit(None).cast("long")
    steps = (("started", F.col("n_rows"), none), ("progress", none, F.col("n_rows")), ("completed", none, none))
    events = F.array(
        *[
            F.struct(
                F.lit(event).alias("event"),
                F.col("dataset_type").alias("dataset_type"),
                total.alias("total_datasets"),
                imported.alias("datasets_imported"),
            )
            for event, total, imported in steps
        ]
    )
    return counts.select(F.inline(events))


def fold_progress(events: DataFrame) -> DataFrame:
    """Status, rows done and rows in all for each dataset type."""
    return events.groupBy("dataset_type").agg(
        F.coalesce(F.max(F.when(F.col("event") == "started", F.col("total_datasets"))), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("event") == "progress", F.col("datasets_imported"))), F.lit(0)).alias(
            "imported"
        ),
        F.when(F.bool_or(F.col("event") == "completed"), COMPLETE).otherwise(WORKING).alias("status"),
    )


def overall_progress(progress: DataFrame) -> DataFrame:
    """Dataset types finished, dataset types seen and rows done, as one row."""
    return progress.agg(
        F.count_if(F.col("status") == COMPLETE).alias("completed_types"),
        F.count(F.lit(1)).alias("total_types"),
        F.coalesce(F.sum("imported"), F.lit(0)).alias("imported"),
    )
