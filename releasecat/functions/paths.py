"""Path and URI expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSOLUTE_URI = "^[^:/]+://"


def physical_file(path: Column | str) -> Column:
    """The path without its URI fragment: members of one archive share it."""
    return F.substring_index(_col(path), "#", 1)


def is_absolute(path: Column | str) -> Column:
    """Does the path start with a URI scheme?"""
    return _col(path).rlike(ABSOLUTE_URI)


def join_root(root: Column | str, path: Column | str) -> Column:
    """Root and relative path with exactly one slash between them."""
    return F.concat(F.rtrim(_col(root), F.lit("/")), F.lit("/"), _col(path))


def lookup(key: Column | str, values: Mapping[str, str]) -> Column:
    """Value for a key out of a mapping held as one literal; NULL for an unknown key."""
    entries = F.from_json(F.lit(json.dumps(dict(values))), "map<string,string>")
    return F.try_element_at(entries, _col(key))


def strip_prefix(uri: Column | str, length: int | Column) -> Column:
    """What follows the first ``length`` characters, without leading slashes."""
    start = length + 1 if isinstance(length, Column) else F.lit(length + 1)
    column = _col(uri)
    return F.ltrim(F.substring(column, start, F.length(column)), F.lit("/"))


def strip_scheme(uri: Column | str, scheme: str = "file://") -> Column:
    """The URI as a local path."""
    column = _col(uri)
    return F.when(column.startswith(scheme), F.substring(column, len(scheme) + 1, 2147483647)).otherwise(column)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
