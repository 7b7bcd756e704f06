"""Text for reports and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names of 1000-based sizes (fixed values).
UNITS = ("kB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def decimal_size(size: Column | str) -> Column:
    """A byte count as 1000-based text: ``1 byte``, ``999 bytes``, ``1.5 kB``."""
    column = F.col(size) if isinstance(size, str) else size
    text = F.when(column == 1, F.lit("1 byte"))
    text = text.when(column < 1000, F.concat(column.cast("long").cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(UNITS[:-1], start=1):
        text = text.when(column < F.lit(float(1000 ** (power + 1))), _scaled(column, power, unit))
    return text.otherwise(_scaled(column, len(UNITS), UNITS[-1]))


def _scaled(size: Column, power: int, unit: str) -> Column:
    # format_number rounds half to even on the exact binary value.
    return F.concat(F.format_number(size.cast("double") / F.lit(float(1000**power)), 1), F.lit(f" {unit}"))


def dataset_file(dataset_type: Column | str) -> Column:
    return F.concat(_col(dataset_type), F.lit(".datasets.parquet"))


def datastore_file(dataset_type: Column | str) -> Column:
    return F.concat(_col(dataset_type), F.lit(".datastore.parquet"))


def association_file(dataset_type: Column | str) -> Column:
    return F.concat(_col(dataset_type), F.lit(".association.parquet"))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
