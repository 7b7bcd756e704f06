"""Checks as tables of violations.

A check is an action of its own: an error raised inside a projection is lost
whenever the projected column is not needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CALIBRATION, TAGGED
from .joins import keep_matching, keep_missing
from .paths import unknown_roots, unmapped_paths
from .selection import unmatched_globs

__all__ = [
    "ReleaseCheckError",
    "bad_association_collections",
    "duplicate_ids",
    "ids_already_loaded",
    "missing_types",
    "null_violations",
    "paths_outside",
    "require_none",
    "schema_differences",
    "unknown_roots",
    "unmapped_paths",
    "unmatched_globs",
]


class ReleaseCheckError(ValueError):
    """A check found violations."""


def require_none(violations: DataFrame, message: str, shown: int = 5) -> None:
    """Raise if there is a violation.  The message shows a few, the check covers all."""
    examples = violations.take(shown)
    if examples:
        raise ReleaseCheckError(f"{message}: {[row.asDict(recursive=True) for row in examples]}")


def missing_types(requested: DataFrame, available: DataFrame, column: str = "name") -> DataFrame:
    """Requested dataset types that are absent."""
    return keep_missing(requested.select(column).distinct(), available, column)


def bad_association_collections(associations: DataFrame, collections: DataFrame) -> DataFrame:
    """Collections with associations that are neither tagged nor calibration, with their entries."""
    counted = associations.groupBy("collection").agg(F.count(F.lit(1)).alias("entries"))
    kinds = collections.select(F.col("name").alias("collection"), "type")
    return counted.join(kinds, "collection", "left").where(
        F.col("type").isNull() | ~F.col("type").isin(TAGGED, CALIBRATION)
    )


def paths_outside(files: DataFrame, column: str = "file") -> DataFrame:
    """Relative paths that leave the directory they are read from, or name the directory itself."""
    parts = F.filter(F.split(F.col(column), "/"), lambda part: ~part.isin("", "."))
    # Depth after each part; ".." goes one up.
    lowest = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("lowest")),
        lambda state, part: F.struct(
            (state["depth"] + F.when(part == "..", -1).otherwise(1)).alias("depth"),
            F.least(state["lowest"], state["depth"] + F.when(part == "..", -1).otherwise(1)).alias("lowest"),
        ),
    )
    return (
        files.withColumn("__walk", lowest)
        .where(F.col(column).startswith("/") | (F.col("__walk.lowest") < 0) | (F.col("__walk.depth") == 0))
        .drop("__walk")
    )


def duplicate_ids(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def ids_already_loaded(incoming: DataFrame, loaded: DataFrame, column: str = "dataset_id") -> DataFrame:
    """Incoming ids that the target has already."""
    return keep_matching(incoming.select(column), loaded, column)


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULLs in columns that must have a value: one row for each such column."""
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return df.sparkSession.createDataFrame([], "column string, nulls long")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in required])
    )
    return counts.select(pairs.alias("row")).select("row.*").where("nulls > 0")


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Columns that are missing, unknown or of another type."""
    actual: Mapping[str, T.DataType] = {f.name: f.dataType for f in df.schema.fields}
    wanted: Mapping[str, T.DataType] = {f.name: f.dataType for f in expected.fields}
    problems: Sequence[str] = [
        *[f"missing {c}" for c in wanted if c not in actual],
        *[f"unknown {c}" for c in actual if c not in wanted],
        *[
            f"{c} is {actual[c].simpleString()}, expected {wanted[c].simpleString()}"
            for c in wanted
            if c in actual and actual[c] != wanted[c]
        ],
    ]
    return list(problems)
