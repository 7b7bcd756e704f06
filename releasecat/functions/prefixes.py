"""The first of many prefixes that fits a string, found by binary search."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FIT = "struct<position:bigint,datastore_name:string,length:int>"
_ARROW = pa.struct([("position", pa.int64()), ("datastore_name", pa.string()), ("length", pa.int32())])


class PrefixIndex:
    """Sorted prefixes; each knows the longest other one that it begins with, and the first in order of all these.

    The longest prefix that fits a string is the last one that is not behind it in the order, or one that this begins
    with: a binary search and then a step for each level at which prefixes are nested.
    """

    def __init__(self, entries: Iterable[tuple[int, str, str]]):
        """``entries`` are positions, prefixes and names; of a repeated prefix the first position counts."""
        first: dict[str, tuple[int, str]] = {}
        for position, prefix, name in entries:
            if prefix not in first or position < first[prefix][0]:
                first[prefix] = (position, name)
        self.prefixes = sorted(first)
        self.outer: list[int] = []
        self.best: list[tuple[int, str, int]] = []
        open_: list[int] = []
        for number, prefix in enumerate(self.prefixes):
            while open_ and not prefix.startswith(self.prefixes[open_[-1]]):
                open_.pop()
            position, name = first[prefix]
            own = (position, name, len(prefix))
            self.outer.append(open_[-1] if open_ else -1)
            self.best.append(min(own, self.best[open_[-1]]) if open_ else own)
            open_.append(number)

    def find(self, text: str) -> tuple[int, str, int] | None:
        """Position, name and length of the prefix that fits and has the least position."""
        number = bisect_right(self.prefixes, text) - 1
        while number >= 0:
            if text.startswith(self.prefixes[number]):
                return self.best[number]
            number = self.outer[number]
        return None

    def column(self, text: Column) -> Column:
        """The fit of each string as a struct; NULL where none fits.  Rows stay where they are."""

        def run(values: pa.Array) -> pa.Array:
            found = [None if value is None else self.find(value) for value in values.to_pylist()]
            rows = [None if fit is None else dict(zip(("position", "datastore_name", "length"), fit)) for fit in found]
            return pa.array(rows, _ARROW)

        return F.arrow_udf(run, FIT)(text)


def _rank(fit: tuple) -> tuple:
    """Order of fits; what has no value comes first, as in Spark."""
    return tuple((value is not None, value) if value is not None else (False,) for value in fit)


def sweep_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fit of each text among the prefixes before it, of rows that are in order.

    Rows of kind 0 are prefixes, those of kind 1 texts; equal prefixes come first.  Only the prefixes that begin the
    row at hand are kept, each with the first in order of all around it.
    """
    around: list[tuple[str, tuple, tuple]] = []
    for batch in batches:
        kinds = batch.column("__kind").to_pylist()
        texts, positions = batch.column("__text").to_pylist(), batch.column("position").to_pylist()
        names, fits = batch.column("datastore_name").to_pylist(), []
        for kind, text, position, name in zip(kinds, texts, positions, names):
            if text is None:
                if kind:
                    fits.append(None)
                continue
            while around and not text.startswith(around[-1][0]):
                around.pop()
            if kind:
                fits.append(around[-1][2] if around else None)
            else:
                fit = (position, name, len(text))
                rank = _rank(fit)
                if around and around[-1][1] < rank:
                    _, rank, fit = around[-1]
                around.append((text, rank, fit))
        kept = batch.filter(pa.array([kind == 1 for kind in kinds], pa.bool_()))
        rows = [None if fit is None else dict(zip(("position", "datastore_name", "length"), fit)) for fit in fits]
        yield pa.RecordBatch.from_arrays(
            [kept.column("__row"), kept.column("__text"), kept.column("__slice"), pa.array(rows, _ARROW)],
            names=["__row", "__text", "__slice", "__fit"],
        )
