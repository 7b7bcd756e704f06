"""Comparison of Spark results with DuckDB on the same Parquet tables."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "tinyint": "TINYINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def differences(df, connection, sql: str) -> list[str]:
    """What is unlike between a DataFrame and SQL: columns, types, rows.  Empty if nothing is."""
    result = connection.execute(sql)
    described = {c[0]: str(c[1]) for c in result.description}
    expected_rows = result.fetchall()
    if sorted(described) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(described)}"]
    problems = []
    for name, kind in df.dtypes:
        if _KINDS.get(kind, kind) != described[name]:
            problems.append(f"{name}: {kind} != {described[name]}")
    order = sorted(described)
    places = {c: i for i, c in enumerate(described)}
    expected = Counter(tuple(normal(row[places[c]]) for c in order) for row in expected_rows)
    actual = Counter(tuple(normal(row[c]) for c in order) for row in df.collect())
    if actual != expected:
        problems.append(f"rows {sum(actual.values())} vs {sum(expected.values())} on {order}")
        problems.append(f"only in Spark: {list((actual - expected).items())[:4]}")
        problems.append(f"only in SQL: {list((expected - actual).items())[:4]}")
    return problems
