"""Collections: nested chains, search order and the tables they are loaded from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CALIBRATION, CHAINED, TAGGED
from ..session import cut_lineage
from .ordering import row_index


class CollectionCycleError(ValueError):
    """A chain contains itself."""


class MissingCollectionError(ValueError):
    """A requested collection does not exist."""


def collection_nodes(collections: DataFrame) -> DataFrame:
    """Every collection without its links; loaded before the links."""
    return collections.select("name", "type", "doc")


def chain_edges(collections: DataFrame) -> DataFrame:
    """One row for each link of a chain to a child, with its place in the chain."""
    return collections.where(F.col("type") == CHAINED).select(
        F.col("name").alias("parent"), F.posexplode("children").alias("position", "child")
    )


def add_alias_chain(collections: DataFrame, source: str, alias: str) -> DataFrame:
    """Add a chain with the children of an existing one; the new name must be free."""
    present = {r[0] for r in collections.where(F.col("name").isin(source, alias)).select("name").collect()}
    if source not in present:
        raise MissingCollectionError(f"No collection {source!r} to copy")
    if alias in present:
        raise ValueError(f"Collection {alias!r} exists already")
    copied = collections.where(F.col("name") == source).select(
        F.lit(alias).alias("name"), F.lit(CHAINED).cast("byte").alias("type"), F.lit("").alias("doc"), "children"
    )
    return collections.unionByName(copied)


WALK = """
WITH RECURSIVE walk(name, search_path, trail) AS (
  SELECT name, search_path, trail FROM {roots}
  UNION ALL
  SELECT link.child, walk.search_path || array(link.position), walk.trail || array(link.child)
  FROM walk JOIN {links} link ON walk.name = link.name
  WHERE NOT array_contains(walk.trail, link.child))
SELECT name, search_path, trail FROM walk
"""


def walk_chains(edges: DataFrame, roots: Sequence[str]) -> DataFrame:
    """Every name reached from ``roots`` with the smallest path that leads to it.

    A path lists the places taken at each level; smallest-first is depth-first order with the first occurrence of a
    name winning.  One recursive query follows the links between chains, which are few beside the links to what is in
    them; those are joined once, to all ways at the same time.  A way ends before it repeats a name, and the link that
    would repeat it is reported as a cycle.

    Where chains nest so that more ways lead through them than a recursive query may return
    (``spark.sql.cteRecursionRowLimit``), the chains are walked level by level with one way for each of them.
    """
    links = edges.select(F.col("parent").alias("name"), "child", F.col("position").cast("bigint").alias("position"))
    parents = links.select(F.col("name").alias("child")).distinct()
    inner = cut_lineage(links.join(parents, "child", "left_semi").select("name", "child", "position"), "chain-links")
    start = _roots(edges.sparkSession, roots)
    try:
        every = edges.sparkSession.sql(WALK, roots=start, links=inner)
        ways = cut_lineage(_smallest_ways(start, every, links), "ways")
    except (PySparkException, Py4JJavaError) as error:
        if "RECURSION_ROW_LIMIT_EXCEEDED" not in str(error):
            raise
        ways = cut_lineage(_smallest_ways(start, _by_levels(start, inner), links), "ways")
    cycle = ways.agg(F.min("cycle")).first()[0]
    if cycle is not None:
        raise CollectionCycleError(cycle)
    return ways.select("name", "search_path")


def _roots(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    return spark.sql(
        "SELECT inline(zip_with(:roots, sequence(0L, size(:roots) - 1L), "
        "(name, place) -> named_struct('name', name, 'search_path', array(place), 'trail', array(name))))",
        args={"roots": F.array(*[F.lit(name) for name in roots])},
    )


def _steps(ways: DataFrame, links: DataFrame) -> DataFrame:
    """Ways one link longer, with the cycle that the link closes if it closes one."""
    path = F.concat("search_path", F.array("position"))
    trail = F.concat("trail", F.array("child"))
    closes = F.when(F.array_contains("trail", F.col("child")), F.array_join(trail, " -> "))
    return ways.join(links, "name").select(
        F.col("child").alias("name"), path.alias("search_path"), trail.alias("trail"), closes.alias("cycle")
    )


def _smallest_ways(start: DataFrame, ways: DataFrame, links: DataFrame) -> DataFrame:
    """The smallest path of the roots and of all that one more link leads to, and a cycle if there is one."""
    reached = _steps(ways, links).select("name", "search_path", "cycle")
    first = start.select("name", "search_path", F.lit(None).cast("string").alias("cycle"))
    return first.unionByName(reached).groupBy("name").agg(
        F.min("search_path").alias("search_path"), F.min("cycle").alias("cycle")
    )


def _by_levels(start: DataFrame, links: DataFrame) -> DataFrame:
    """A way to each chain, level by level.

    The smallest way to a child extends the smallest way to one of its chains, so a level keeps one way for a name.  A
    level is as small as the number of names however many ways lead to them, and a cycle ends the walk.
    """
    levels, frontier = [start], start
    while True:
        way = F.struct("search_path", "trail", "cycle")
        level = _steps(frontier, links).groupBy("name").agg(F.min(way).alias("way"), F.min("cycle").alias("closed"))
        stored = cut_lineage(level.select("name", "way.search_path", "way.trail", "closed"), "level")
        seen = stored.agg(F.count(F.lit(1)).alias("names"), F.count("closed").alias("closed")).first()
        if seen["closed"] or not seen["names"]:
            return reduce(DataFrame.unionByName, levels)
        frontier = stored.select("name", "search_path", "trail")
        levels.append(frontier)


def flatten_collections(collections: DataFrame, roots: Sequence[str]) -> DataFrame:
    """Rows of the roots and all collections nested in them, with ``search_rank``.

    Chains stay in the result as rows of their own.
    """
    ways = walk_chains(chain_edges(collections), roots)
    ranked = row_index(ways, ["search_path"], "search_rank").select("name", "search_rank")
    resolved = cut_lineage(
        ranked.join(collections, "name", "left").select(*collections.columns, "search_rank"), "collections"
    )
    absent = resolved.where(F.col("type").isNull()).select("name").take(5)
    if absent:
        raise MissingCollectionError(f"Collections do not exist: {[row['name'] for row in absent]}")
    return resolved


def search_collections(collections: DataFrame) -> DataFrame:
    """Collections that hold datasets themselves: all but chains."""
    return collections.where(F.col("type") != CHAINED)


def association_collections(collections: DataFrame) -> DataFrame:
    """Collections that hold associations: tagged and calibration."""
    return collections.where(F.col("type").isin(TAGGED, CALIBRATION))
