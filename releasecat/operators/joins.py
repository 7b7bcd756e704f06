"""Joins on keys.

No side is marked for broadcast here: Spark broadcasts a side itself when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles, where adaptive execution splits a hot key.  The key side is made
distinct before it is shuffled, so only the split side can hold a hot key.

That size is not measured where a side is read from files: it is that of the
files, cut down to the columns in use, and once a broadcast is planned adaptive
execution keeps it, as the shuffles of the other plan cost more.  Keys next to
columns without values look a hundred times smaller than they are.  Sides that
grow with the release are therefore ``shuffled``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

On = str | Sequence[str] | Mapping[str, str]


def as_pairs(on: On) -> dict[str, str]:
    """Join columns as left name -> right name."""
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def key_set(keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct keys.  A key with a NULL equals nothing, so it is dropped before the shuffle."""
    return keys.select(*columns).dropna().distinct()


def shuffled(keys: DataFrame) -> DataFrame:
    """The key side of a join that must not pass through the driver, however small its files look."""
    return keys.hint("merge")


def keep_matching(df: DataFrame, keys: DataFrame, on: On, unique_keys: bool = False) -> DataFrame:
    """Rows whose key is present in ``keys``; ``unique_keys`` says that they need no ``distinct``."""
    return _existence(df, keys, as_pairs(on), unique_keys, "left_semi")


def keep_missing(df: DataFrame, keys: DataFrame, on: On, unique_keys: bool = False) -> DataFrame:
    """Rows whose key is absent from ``keys``; a row with a NULL key is kept."""
    return _existence(df, keys, as_pairs(on), unique_keys, "left_anti")


def keep_matching_all(
    tables: Mapping[str, DataFrame], keys: DataFrame, on: On, unique_keys: bool = False
) -> dict[str, DataFrame]:
    """The same key filter on several tables."""
    return {name: keep_matching(table, keys, on, unique_keys) for name, table in tables.items()}


def keep_matching_any(df: DataFrame, *key_sets: tuple[DataFrame, On]) -> DataFrame:
    """Distinct rows whose key is present in at least one of the key sets.

    Every key set only adds a flag through a left join on distinct keys, so the
    table is never multiplied and a hot key can still be split.
    """
    flagged = df
    flags = []
    for index, (keys, on) in enumerate(key_sets):
        pairs = as_pairs(on)
        flag = f"__match_{index}"
        renamed = key_set(keys, list(pairs.values())).select(
            *[F.col(right).alias(f"__key_{index}_{left}") for left, right in pairs.items()],
            F.lit(True).alias(flag),
        )
        condition = reduce(
            Column.__and__, [flagged[left] == renamed[f"__key_{index}_{left}"] for left in pairs]
        )
        flagged = flagged.join(renamed, condition, "left")
        flags.append(F.col(flag).isNotNull())
    return flagged.where(reduce(Column.__or__, flags)).select(*df.columns).distinct()


def other_side(definition: DataFrame, keys: DataFrame, on: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Columns found on the other side of a many-to-many table for a set of keys."""
    return definition.join(key_set(keys, on), list(on)).select(*wanted)


def orphans(child: DataFrame, parent: DataFrame, on: On) -> DataFrame:
    """Child rows that refer to no parent row; a NULL reference refers to nothing and is no orphan."""
    pairs = as_pairs(on)
    return keep_missing(child.dropna(subset=list(pairs)), shuffled(parent), pairs)


def skip_existing(plan: DataFrame, listing: DataFrame, on: On = "destination") -> DataFrame:
    """Planned transfers whose destination is not there yet."""
    return keep_missing(plan, listing, on)


def already_there(plan: DataFrame, listing: DataFrame, on: On = "destination") -> DataFrame:
    """Planned transfers whose destination is there already."""
    return keep_matching(plan, listing, on)


def fill_sizes(files: DataFrame, listing: DataFrame, file: str = "file", size: str = "size") -> DataFrame:
    """Add the listed size of each file; NULL where the listing does not have it."""
    sizes = listing.groupBy(file).agg(F.max(size).alias(size))
    return files.join(sizes, file, "left")


def _existence(df: DataFrame, keys: DataFrame, pairs: dict[str, str], unique_keys: bool, how: str) -> DataFrame:
    right = list(pairs.values())
    wanted = keys.select(*right) if unique_keys else key_set(keys, right)
    renamed = wanted.select(*[F.col(r).alias(f"__key_{left}") for left, r in pairs.items()])
    condition = reduce(Column.__and__, [df[left] == renamed[f"__key_{left}"] for left in pairs])
    return df.join(renamed, condition, how)
