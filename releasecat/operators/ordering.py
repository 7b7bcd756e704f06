"""Orders and running totals that never pass through a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_SLICE = "__slice"
_BEFORE = "__before"


def sort_by(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending order with NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def running_total(
    df: DataFrame, order: Sequence[str], value: Column | str, name: str, slices: int | None = None
) -> DataFrame:
    """Running sum of ``value`` along ``order``, which must identify a row.

    The rows are cut into ranges of the order and stored, so that every later
    step sees the same cut.  Each range is summed; the sums of the ranges
    before it, one number for each range, are then added inside it.
    """
    column = F.col(value) if isinstance(value, str) else value
    ordering = [F.col(c).asc_nulls_last() for c in order]
    count = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        df.withColumn(name, column.cast("long"))
        .repartitionByRange(count, *ordering)
        .withColumn(_SLICE, F.spark_partition_id())
    )
    # One row for each range, at most ``count`` rows: small enough for one task and a broadcast.
    sums = placed.groupBy(_SLICE).agg(F.sum(name).alias(_BEFORE))
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(_SLICE, F.coalesce(F.sum(_BEFORE).over(earlier), F.lit(0)).alias(_BEFORE))
    inside = Window.partitionBy(_SLICE).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(offsets), _SLICE)
        .withColumn(name, F.col(_BEFORE) + F.coalesce(F.sum(name).over(inside), F.lit(0)))
        .drop(_SLICE, _BEFORE)
    )


def row_index(df: DataFrame, order: Sequence[str], name: str, slices: int | None = None) -> DataFrame:
    """Position of each row in ``order``, from 0 without gaps."""
    return running_total(df, order, F.lit(1), name, slices).withColumn(name, F.col(name) - 1)
