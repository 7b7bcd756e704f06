"""Whole Arrow batches of text as byte arrays: words, shingles and hashes without a Python loop over words.

A word is a run of ASCII letters and digits and of non-ASCII characters; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

# Bytes of text that are turned into arrays at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE_BASE = 0xD1342543DE82EF95

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_powers: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    """Words of some texts: the text of each, where its bytes are, its hash, and the first word of each text."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the package, and Arrow batches that stay small with long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def partitions(df: DataFrame) -> int:
    """Number of partitions for an explicit exchange: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keep(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the columns an operator works on, under its own names, so that no further column can clash."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """``base ** 0 .. count - 1`` modulo 2**64."""
    table = _powers.get(base)
    if table is None or len(table) < count:
        factors = np.full(max(count, SLICE_BYTES + 4096), base, np.uint64)
        factors[0] = 1
        table = _powers[base] = np.cumprod(factors)
    return table[:count]


def prefix_hashes(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Running polynomial sums, from which ``span_hashes`` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    inverse = _INVERSE if base == _BASE else pow(base, -1, 1 << 64)
    return mix((sums[end] - sums[start]) * powers(inverse, len(sums))[start])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return offsets - offsets[0], np.zeros(0, np.uint8)
    return offsets - offsets[0], np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its text reaches ``limit`` bytes."""
    ends = utf8(batch.column(text))[0][1:]
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def words(offsets: np.ndarray, data: np.ndarray) -> Words:
    """All words of the texts; words never join two texts."""
    inside = _IN_WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(text, start, end, span_hashes(prefix_hashes(_FOLD[data]), start, end), first)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, and the indexes of the words where they exist."""
    count = len(w.hash) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total += w.hash[place : place + count] * np.uint64(pow(_SHINGLE_BASE, place, 1 << 64))
    at = np.flatnonzero(w.text[:count] == w.text[size - 1 :])
    return mix(total[at]), at


def runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the length of the array."""
    if len(keys) == 0:
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value for each span of ``values`` between neighbouring bounds, without copying."""
    values = np.ascontiguousarray(values)
    offsets = (np.asarray(bounds) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])
