"""Whitening of embeddings by shifted Cholesky QR: Gram passes over the rows, small factors on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import keep

UNIT = float(np.finfo(np.float64).eps) / 2


class Whitening(NamedTuple):
    """Components to return, steps of an entry's unit and the long that zero becomes, greatest magnitude of an entry,
    how near the Gram matrix must be to a projection, and the most Gram passes."""

    components: int = 32
    steps: float = 64.0
    zero: int = 1_000_000
    greatest: float = float(1 << 40)
    near: float = 1e-13
    passes: int = 8


class Fit(NamedTuple):
    """What the passes have found: rows, sums by dimension, components as columns, their eigenvalues, the trace."""

    rows: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float


def vectors(column: pa.Array, rule: Whitening) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers of the vectors that count, and their entries as longs, in runs of equal length.

    A vector that is null or empty, or holds an entry that is null, not finite or beyond ``rule.greatest``, does not
    count.
    """
    lists = column.cast(pa.list_(pa.float64())) if len(column) else pa.array([], pa.list_(pa.float64()))
    flat = pc.fill_null(lists.flatten(), np.nan).to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    with np.errstate(invalid="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(flat) <= rule.greatest))])
    good = np.flatnonzero((lengths > 0) & (bad[ends] == bad[ends - lengths]))
    cuts = np.flatnonzero(np.diff(lengths[good])) + 1
    found = []
    for run in np.split(good, cuts) if len(good) else []:
        at = (ends[run] - lengths[run])[:, None] + np.arange(lengths[run[0]])
        found.append(np.floor(rule.steps * flat[at]).astype(np.int64) + rule.zero)
    return good, found


def centred(x: np.ndarray, rows: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` without rounding before the division: ``n x - S`` is a whole number."""
    return (x * rows - sums) / rows


def solved(a: np.ndarray, triangles: Sequence[np.ndarray]) -> np.ndarray:
    """Rows ``Q`` of ``Q R = A`` for one triangle after the other."""
    for triangle in triangles:
        a = np.linalg.solve(triangle.T, a.T).T
    return a


def most_common_length(rows: DataFrame, rule: Whitening) -> tuple[int, int, np.ndarray]:
    """Length of most vectors (of ties the longest), how many have it, and their exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for x in vectors(batch.column("vector"), rule)[1]:
                total = totals.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
                total[0] += len(x)
                total[1] = total[1] + x.sum(0).astype(object)
        for length, (count, total) in totals.items():
            names = ["length", "place", "total"]
            columns = [[length] * (length + 1), [*range(length), -1], [*map(int, total), count]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    parts = rows.select("vector").mapInArrow(run, "length long, place long, total long")
    totals = parts.groupBy("length", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    # One row for each length that occurs; then one for each dimension of the chosen length.
    counts = totals.where("place = -1").orderBy(F.desc("total"), F.desc("length")).select("length", "total").first()
    if counts is None:
        return 0, 0, np.zeros(0, np.int64)
    sums = totals.where((F.col("length") == counts["length"]) & (F.col("place") >= 0)).orderBy("place").collect()
    return int(counts["length"]), int(counts["total"]), np.array([int(r["total"]) for r in sums], np.int64)


def gram(rows: DataFrame, length: int, project: Callable[[np.ndarray], np.ndarray], width: int, rule: Whitening) -> np.ndarray:
    """``Q'Q`` of the projected rows, and their sums in a last row.

    A task sends its own products once, the upper half of ``width`` squared numbers, and these are summed by place
    before the driver takes them: what arrives there depends on the width alone.
    """
    upper = np.triu_indices(width)
    places = np.concatenate([upper[0] * width + upper[1], width * width + np.arange(width)]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, some = np.zeros((width, width)), np.zeros(width), False
        for batch in batches:
            for x in vectors(batch.column("vector"), rule)[1]:
                if x.shape[1] == length:
                    q, some = project(x), True
                    total += q.T @ q
                    sums += q.sum(0)
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.concatenate([total[upper], sums]))], ["place", "total"])

    parts = rows.select("vector").mapInArrow(run, "place long, total double")
    summed = parts.groupBy("place").agg(F.sum("total").alias("total")).toPandas()
    table = np.zeros((width + 1) * width)
    table[summed["place"].to_numpy(np.int64)] = summed["total"].to_numpy()
    table = table.reshape(width + 1, width)
    table[:width] = np.triu(table[:width]) + np.triu(table[:width], 1).T
    return table


def fit(rows: DataFrame, rule: Whitening) -> Fit:
    """Components of the rows' covariance by shifted Cholesky QR.

    Each pass takes the Gram matrix ``G`` of the centred rows after triangular solves with the factors so far.  ``G`` plus a
    shift, which keeps it positive whatever the condition of the rows, is factored into a triangle that joins the
    product ``R`` of all factors.  The passes end when ``G`` is a projection up to rounding: the identity, but for
    dimensions that depend on others.  The rows are then ``Q R`` with ``Q'Q = G``, so that the SVD of ``sqrt(G) R``
    has the axes and lengths of the rows without ever squaring their condition.
    """
    length, count, sums = most_common_length(rows, rule)
    nothing = Fit(count, sums, np.zeros((length, 0)), np.zeros(0), 0.0)
    if count < 2:
        return nothing
    factor, triangles, seen = np.eye(length), [], None
    for step in range(rule.passes):
        found = gram(rows, length, lambda x, so_far=tuple(triangles): solved(centred(x, count, sums), so_far), length, rule)[:length]
        seen = found if seen is None else seen
        values, axes = np.linalg.eigh(found)
        if values[-1] <= 0:
            return nothing
        if step > 1 and np.all(np.minimum(np.abs(values), np.abs(values - 1)) < rule.near * max(length, 64)):
            break
        shift = 11 * (count * length + length * (length + 1)) * UNIT * values[-1] if step == 0 else 11 * length * UNIT * values[-1]
        # A first shift that grows with the rows would hide short axes; what rounding can spoil is bounded by the width.
        shift = min(shift, 1e-6 * values[-1])
        triangle = np.linalg.cholesky(found + shift * np.eye(length)).T
        factor = triangle @ factor
        triangles.append(triangle)
    root = (axes * np.sqrt(np.maximum(values, 0))) @ axes.T
    _, lengths, right = np.linalg.svd(root @ factor)
    values = lengths**2 / count
    real = lengths > lengths[0] * length * UNIT * 16
    axes = right[real].T
    # Either sign is right; the largest entry of an axis is made positive, so that every run gives the same one.
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    return Fit(count, sums, axes, values[real], float(np.trace(seen)) / count)


def deviations(x: np.ndarray, rows: int, sums: np.ndarray) -> pa.Array:
    """Exact sum of ``(n x - S) ** 2`` of each vector; null where it is beyond a long."""
    apart = x * rows - sums
    if len(x) and float(np.abs(apart).max()) ** 2 * x.shape[1] >= 2.0**62:
        exact = [sum(v * v for v in row) for row in apart.tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
    return pa.array((apart * apart).sum(1), pa.int64())


def whiten(
    embeddings: DataFrame, rule: Whitening = Whitening(), id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each vector and component.

    Entries become the longs ``floor(64 c) + 1000000``; components are numbered from 1 by falling eigenvalue of their
    covariance, at most ``rule.components``.  A vector that is null, empty, or has an entry that is null, not finite
    or greater than ``rule.greatest``, is left out, and so are vectors of another length than most have (of ties the
    longest).  Axes along which no vector differs have no component: fewer than two vectors, or equal ones, and empty
    tables give no rows.  Rows with one id, with none, or with equal vectors stay rows of their own; all of them are
    in the fit.  ``deviation`` is null where it is beyond a long.

    The driver holds matrices of the width of a vector squared, whatever the number of rows; each pass reads the
    vector column only.
    """
    rows = keep(embeddings, vec_id=id_column, vector=vector_column)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    found = fit(rows, rule)
    width = min(rule.components, len(found.values))
    if width == 0:
        return embeddings.sparkSession.createDataFrame([], schema)
    length, explained = len(found.sums), found.values[:width] / found.trace
    scaled = found.axes[:, :width] / np.sqrt(found.values[:width])

    def project(x: np.ndarray) -> np.ndarray:
        return centred(x, found.rows, found.sums) @ scaled

    table = gram(rows, length, project, width, rule) / found.rows
    covariance = table[:width] - np.outer(table[width], table[width])
    error = float(np.abs(covariance - np.eye(width)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, parts = vectors(batch.column("vector"), rule)
            done = 0
            for x in parts:
                ids = batch.column("vec_id").take(pa.array(good[done : done + len(x)]))
                done += len(x)
                if x.shape[1] != length:
                    continue
                each, size = pa.array(np.repeat(np.arange(len(x)), width)), len(x) * width
                columns = [
                    ids.take(each),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, found.rows, np.int64)),
                    deviations(x, found.rows, found.sums).take(each),
                    pa.array(project(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(size, error)),
                ]
                names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)
