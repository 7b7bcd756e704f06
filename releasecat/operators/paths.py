"""Path operators on file records."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import is_absolute, join_root, lookup, physical_file, strip_prefix
from ..functions.prefixes import FIT, PrefixIndex, sweep_prefixes
from ..schemas import as_nullable
from ..session import cut_lineage
from .selection import union_by_name


def make_paths_absolute(
    datastore: DataFrame, roots: Mapping[str, str] | DataFrame, name: str = "datastore_name", path: str = "path"
) -> DataFrame:
    """Prefix relative paths with the root of their datastore; URIs stay.

    The path is NULL where the root is not known, see ``unknown_roots``.
    """
    rooted = _with_root(datastore, roots, name)
    absolute = F.when(is_absolute(path), F.col(path)).otherwise(join_root("__root", path))
    return rooted.withColumn(path, absolute).drop("__root")


def unknown_roots(
    datastore: DataFrame, roots: Mapping[str, str] | DataFrame, name: str = "datastore_name", path: str = "path"
) -> DataFrame:
    """Relative paths in a datastore without a root."""
    return _with_root(datastore, roots, name).where(~is_absolute(path) & F.col("__root").isNull()).drop("__root")


def map_to_datastores(
    datastore: DataFrame,
    mapping: Mapping[str, str] | DataFrame,
    name: str = "datastore_name",
    path: str = "path",
) -> DataFrame:
    """Split URIs into a datastore and a relative path by the first prefix that fits.

    First means in the order of ``mapping``, not the longest, and a prefix may
    end inside a path segment.  A mapping table has ``prefix``,
    ``datastore_name`` and ``position``.  Both results are NULL where no prefix
    fits, see ``unmapped_paths``.
    """
    matched = _with_mapping(datastore, mapping, path)
    return matched.withColumns(
        {
            name: F.col("__fit.datastore_name"),
            path: F.when(F.col("__fit").isNotNull(), strip_prefix(path, F.col("__fit.length"))),
        }
    ).drop("__fit")


def unmapped_paths(datastore: DataFrame, mapping: Mapping[str, str] | DataFrame, path: str = "path") -> DataFrame:
    """URIs under none of the prefixes."""
    return _with_mapping(datastore, mapping, path).where(F.col("__fit").isNull()).drop("__fit")


def file_list(*datastores: DataFrame, path: str = "path") -> DataFrame:
    """Distinct physical files of any number of record tables, as ``file``."""
    return union_by_name([d.select(physical_file(path).alias("file")) for d in datastores]).distinct()


class AmbiguousRootError(ValueError):
    """A datastore has more than one root."""


def _with_root(datastore: DataFrame, roots: Mapping[str, str] | DataFrame, name: str) -> DataFrame:
    if not isinstance(roots, DataFrame):
        return datastore.withColumn("__root", lookup(name, roots))
    table = roots.groupBy(F.col("datastore_name").alias("__name")).agg(
        F.min("root").alias("__root"), F.count_distinct("root").alias("__roots")
    )
    twice = table.where("__roots > 1").select("__name").take(5)
    if twice:
        raise AmbiguousRootError(f"More than one root for {[row[0] for row in twice]}")
    return datastore.join(table.drop("__roots"), datastore[name] == table["__name"], "left").drop("__name")


# Up to how many prefixes are literals of the plan, and how many prefixes and characters of them a task may hold.
LITERAL_PREFIXES = 64
INDEX_PREFIXES = 1_000_000
INDEX_CHARACTERS = 64_000_000
_FIT = FIT


def _with_mapping(datastore: DataFrame, mapping: Mapping[str, str] | DataFrame, path: str) -> DataFrame:
    if isinstance(mapping, DataFrame):
        return _table_mapping(datastore, mapping, path)
    if len(mapping) > LITERAL_PREFIXES:
        # The caller holds the mapping already; it goes to each executor once.
        entries = [(position, prefix, name) for position, (prefix, name) in enumerate(mapping.items())]
        return datastore.withColumn("__fit", PrefixIndex(entries).column(F.col(path)))
    # One literal map for each length of prefix: no row moves.
    by_length: dict[int, dict[str, dict]] = {}
    for position, (prefix, name) in enumerate(mapping.items()):
        fit = {"position": position, "datastore_name": name, "length": len(prefix)}
        by_length.setdefault(len(prefix), {})[prefix] = fit
    fits = [
        F.try_element_at(F.from_json(F.lit(json.dumps(fit)), f"map<string,{_FIT}>"), F.substring(path, 1, length))
        for length, fit in by_length.items()
    ]
    return datastore.withColumn("__fit", _earliest(fits))


def _table_mapping(datastore: DataFrame, mapping: DataFrame, path: str) -> DataFrame:
    """A mapping table is measured once it is stored: what a task can hold is searched there, so that records stay
    where they are; a larger one is swept along with them."""
    grouped = mapping.groupBy("prefix").agg(F.min(F.struct("position", "datastore_name")).alias("target"))
    prefixes = cut_lineage(grouped.select("prefix", "target.position", "target.datastore_name"), "mapping")
    size = prefixes.agg(
        F.count(F.lit(1)).alias("prefixes"),
        F.coalesce(F.sum(F.length("prefix") + F.length("datastore_name")), F.lit(0)).alias("characters"),
        F.coalesce(F.max(F.length("prefix")), F.lit(0)).alias("longest"),
    ).first()
    if size["prefixes"] > INDEX_PREFIXES or size["characters"] > INDEX_CHARACTERS:
        return _sweep_mapping(datastore, prefixes, size["longest"], path)
    entries = prefixes.select(F.col("position").cast("long"), "prefix", "datastore_name").collect()
    return datastore.withColumn("__fit", PrefixIndex(entries).column(F.col(path)))


def _earliest(fits: list[Column]) -> Column:
    """The fit that comes first in the mapping; NULL without any."""
    fits = [*fits, F.lit(None).cast(_FIT)]
    return F.least(*fits) if len(fits) > 1 else fits[0]


_SWEPT = "__text string, __slice int, __fit " + FIT


def _sweep_mapping(datastore: DataFrame, mapping: DataFrame, longest: int, path: str) -> DataFrame:
    """Records and prefixes are brought into one order and dealt in ranges of it; a sweep over a range knows the
    prefixes that its place lies in.

    A prefix of an earlier range that begins any text of a range begins its first text too, because all texts between
    have the same beginning.  So the beginnings of one text for each range are looked for in the mapping, and what is
    found is compared with the texts of that range.  Every record moves once, however many lengths there are.
    """
    order = ["__text", "__kind", "__spread"]
    record = datastore.select(F.struct("*").alias("__row"), F.col(path).alias("__text"))
    records = record.select(
        "__row",
        "__text",
        F.lit(1).alias("__kind"),
        # Equal texts are cut into ranges too.
        F.monotonically_increasing_id().alias("__spread"),
        F.lit(None).cast("bigint").alias("position"),
        F.lit(None).cast("string").alias("datastore_name"),
    )
    prefixes = mapping.select(
        F.lit(None).cast(record.schema["__row"].dataType).alias("__row"),
        F.col("prefix").alias("__text"),
        F.lit(0).alias("__kind"),
        F.lit(0).cast("bigint").alias("__spread"),
        F.col("position").cast("bigint").alias("position"),
        "datastore_name",
    )
    ranges = records.unionByName(prefixes).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranges.select("__row", "__text", "__kind", F.spark_partition_id().alias("__slice"), "position", "datastore_name")
    rows = T.StructType([T.StructField("__row", record.schema["__row"].dataType), *T._parse_datatype_string(_SWEPT).fields])
    swept = cut_lineage(placed.mapInArrow(sweep_prefixes, as_nullable(rows)), "fits")

    first = swept.groupBy("__slice").agg(F.min("__text").alias("__first"))
    cuts = F.sequence(F.lit(0), F.least(F.length("__first"), F.lit(longest)))
    begins = first.select("__slice", "__first", F.explode(cuts).alias("__cut")).select(
        "__slice", F.substring("__first", F.lit(1), F.col("__cut")).alias("prefix")
    )
    outer = F.struct("prefix", F.struct(F.col("position").cast("bigint"), "datastore_name", F.length("prefix").alias("length")).cast(FIT).alias("fit"))
    # As many rows as there are ranges, each with the prefixes that are nested around one text.
    around = mapping.join(begins, "prefix").groupBy("__slice").agg(F.collect_list(outer).alias("__around"))
    holds = F.filter("__around", lambda one: F.startswith(F.col("__text"), one["prefix"]))
    earliest = F.array_min(F.transform(holds, lambda one: one["fit"]))
    joined = swept.join(F.broadcast(around), "__slice", "left")
    return joined.select("__row.*", F.least("__fit", earliest).alias("__fit"))
