"""Results handed to the driver."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched
from typing import Any

from pyspark.sql import DataFrame


def fetch_batches(df: DataFrame, size: int = 10_000) -> Iterator[list[Any]]:
    """A single column as lists of at most ``size`` values, one partition in memory at a time.

    For consumers outside Spark.  Work that can run in tasks uses ``assign_batches``.
    """
    if len(df.columns) != 1:
        raise ValueError(f"Expected one column, got {df.columns}")
    for rows in batched(df.toLocalIterator(), size):
        yield [row[0] for row in rows]


def fetch_scalar(df: DataFrame) -> Any:
    """The value of a result with one row and one column."""
    rows = df.take(2)
    if len(rows) != 1 or len(df.columns) != 1:
        raise ValueError(f"Expected one value, got {len(rows)} rows of {df.columns}")
    return rows[0][0]
