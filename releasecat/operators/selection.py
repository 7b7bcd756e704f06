"""Filters and column rewrites."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.globs import glob_to_regex, matches_any
from ..schemas import DimensionSpec


class UnmatchedPatternError(ValueError):
    """A requested name or glob matches nothing."""


def select_types(df: DataFrame, globs: Iterable[str], column: str = "name") -> DataFrame:
    """Rows whose name matches one of the globs; each row once, in one pass."""
    return df.where(matches_any(column, globs))


def unmatched_globs(df: DataFrame, globs: Sequence[str], column: str = "name") -> DataFrame:
    """The globs that match no row, found in one pass over the names."""
    flags = [
        F.coalesce(F.max(F.col(column).rlike(glob_to_regex(glob))), F.lit(False)).alias(f"g{index}")
        for index, glob in enumerate(globs)
    ]
    rows = F.explode(
        F.array(*[F.struct(F.lit(g).alias("pattern"), F.col(f"g{i}").alias("found")) for i, g in enumerate(globs)])
    )
    return df.agg(*flags).select(rows.alias("row")).select("row.*").where("NOT found").select("pattern")


def resolve_names(df: DataFrame, patterns: Sequence[str], column: str = "name") -> DataFrame:
    """Rows selected by names and globs; an error lists every pattern that matches nothing."""
    patterns = list(patterns)
    if not patterns:
        return df.where(F.lit(False))
    absent = [row["pattern"] for row in unmatched_globs(df, patterns, column).collect()]
    if absent:
        raise UnmatchedPatternError(f"Nothing matches: {absent}")
    return select_types(df, patterns, column)


def drop_value(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows with another value; a row without a value is dropped too."""
    return df.where(F.col(column) != F.lit(value))


def without_size(datastore: DataFrame, size: str = "file_size") -> DataFrame:
    return datastore.where(F.col(size).isNull())


def with_size(datastore: DataFrame, size: str = "file_size") -> DataFrame:
    return datastore.where(F.col(size).isNotNull())


def patch_where(df: DataFrame, key: str, keys: Sequence[object], column: str, value: object) -> DataFrame:
    """Set a column to a constant where the key is one of ``keys``."""
    return df.withColumn(column, F.when(F.col(key).isin(list(keys)), F.lit(value)).otherwise(F.col(column)))


def project_data_id(df: DataFrame, spec: DimensionSpec, dimensions: Iterable[str]) -> DataFrame:
    """``dataset_id``, ``run`` and the required dimensions only."""
    return df.select("dataset_id", "run", *spec.required(dimensions))


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All tables as one; a column a table does not have is NULL."""
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table, allowMissingColumns=True)
    return union


def rewrite_columns(
    df: DataFrame,
    function: Callable[[list[dict]], None],
    columns: Sequence[str] = ("datastore_name", "path"),
) -> DataFrame:
    """Replace columns with what a Python function makes of them, batch by batch.

    The function edits a list of rows in place.  Only the named columns become
    Python objects; the others stay in Arrow.  For rules that can be said as
    expressions use ``make_paths_absolute`` and ``map_to_datastores``.
    """
    wanted = list(columns)

    def rewrite(batches):
        for batch in batches:
            rows = batch.select(wanted).to_pylist()
            function(rows)
            for name in wanted:
                index = batch.schema.get_field_index(name)
                field = batch.schema.field(index)
                batch = batch.set_column(index, field, pa.array([row[name] for row in rows], field.type))
            yield batch

    return df.mapInArrow(rewrite, df.schema)
