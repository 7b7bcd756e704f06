"""Identifiers and time spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TIMESPAN


def uuid_to_binary(text: Column | str) -> Column:
    """16 bytes of a UUID written with or without dashes."""
    return F.unhex(F.replace(_col(text), F.lit("-"), F.lit("")))


def binary_to_hex(value: Column | str) -> Column:
    """32 lower-case hex digits."""
    return F.lower(F.hex(_col(value)))


def binary_to_uuid(value: Column | str) -> Column:
    """UUID text with dashes."""
    digits = binary_to_hex(value)
    bounds = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digits, start, length) for start, length in bounds])


def timespan(begin_nsec: Column, end_nsec: Column) -> Column:
    """Time span out of two nanosecond columns; a NULL end is open."""
    return F.struct(begin_nsec.cast("long").alias("begin_nsec"), end_nsec.cast("long").alias("end_nsec"))


def unbounded() -> Column:
    """The time span that is open at both ends."""
    return F.struct(F.lit(None).cast("long").alias("begin_nsec"), F.lit(None).cast("long").alias("end_nsec")).cast(
        TIMESPAN
    )


def or_unbounded(value: Column | str) -> Column:
    """A missing time span means valid for ever."""
    return F.coalesce(_col(value), unbounded())


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
