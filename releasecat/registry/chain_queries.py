"""Queries on collections and their chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import binary_to_hex
from ..operators.collections import (
    add_alias_chain,
    association_collections,
    chain_edges,
    collection_nodes,
    search_collections,
    walk_chains,
)
from ..operators.ordering import row_index
from ..operators.search import associations, extra_runs, find_first, runs_found, search, search_all
from ..plans.export import select_datasets
from ..session import cut_lineage
from . import adapters
from .base import query, table


def geography_edges(spark, sf_dir):
    """World -> regions -> nations -> customers and suppliers, each child placed by its key."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    nation_name = F.concat(F.lit("n"), F.col("n_nationkey"))
    levels = [
        region.select(F.lit("world").alias("parent"), F.col("r_regionkey").alias("position"), region_name().alias("child")),
        nation.select(
            region_name("n_regionkey").alias("parent"), F.col("n_nationkey").alias("position"), nation_name.alias("child")
        ),
        customer.select(
            F.concat(F.lit("n"), F.col("c_nationkey")).alias("parent"),
            F.col("c_custkey").alias("position"),
            F.concat(F.lit("c"), F.col("c_custkey")).alias("child"),
        ),
        # Every supplier is in its nation and directly in the world, which comes later.
        supplier.select(
            F.concat(F.lit("n"), F.col("s_nationkey")).alias("parent"),
            (F.col("s_suppkey") + 10_000_000_000).alias("position"),
            F.concat(F.lit("s"), F.col("s_suppkey")).alias("child"),
        ),
        supplier.select(
            F.lit("world").alias("parent"),
            (F.col("s_suppkey") + 100).alias("position"),
            F.concat(F.lit("s"), F.col("s_suppkey")).alias("child"),
        ),
    ]
    return reduce(
        DataFrame.unionByName, [level.withColumn("position", F.col("position").cast("long")) for level in levels]
    )


def region_name(column: str = "r_regionkey"):
    return F.concat(F.lit("r"), F.col(column))


GEOGRAPHY_SQL = """
edges(parent, position, child) AS (
  SELECT 'world', CAST(r_regionkey AS BIGINT), 'r' || r_regionkey FROM region
  UNION ALL SELECT 'r' || n_regionkey, n_nationkey, 'n' || n_nationkey FROM nation
  UNION ALL SELECT 'n' || c_nationkey, c_custkey, 'c' || c_custkey FROM customer
  UNION ALL SELECT 'n' || s_nationkey, s_suppkey + 10000000000, 's' || s_suppkey FROM supplier
  UNION ALL SELECT 'world', s_suppkey + 100, 's' || s_suppkey FROM supplier)
"""


@query(
    "flatten_chain",
    f"""
    WITH RECURSIVE {GEOGRAPHY_SQL},
    walk(name, path) AS (
      SELECT 'world', [CAST(0 AS BIGINT)]
      UNION ALL SELECT e.child, list_append(w.path, e.position) FROM walk w JOIN edges e ON w.name = e.parent),
    firsts AS (SELECT name, min(path) AS path FROM walk GROUP BY name)
    SELECT name, len(path) - 1 AS depth, row_number() OVER (ORDER BY path) - 1 AS search_rank FROM firsts
    """,
)
def flatten_chain(spark, sf_dir):
    """Depth-first search order over four levels; the first way to a name counts."""
    ways = walk_chains(geography_edges(spark, sf_dir), ["world"])
    ranked = row_index(ways, ["search_path"], "search_rank")
    return ranked.select("name", (F.size("search_path") - 1).cast("long").alias("depth"), "search_rank")


_NATION_CHAINS_SQL = """
chains AS (
  SELECT 'r' || n_regionkey AS name, n_name AS child,
         row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS position
  FROM nation)
"""


def _nation_collections(spark, sf_dir):
    # There are 25 nations at any scale, so a region's chain is a short list.
    listed = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    chains = (
        table(spark, sf_dir, "nation")
        .groupBy(F.concat(F.lit("r"), F.col("n_regionkey")).alias("name"))
        .agg(F.transform(listed, lambda nation: nation["n_name"]).alias("children"))
        .select("name", F.lit(3).cast("byte").alias("type"), F.lit("region").alias("doc"), "children")
    )
    runs = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"),
        F.lit(1).cast("byte").alias("type"),
        F.lit("nation").alias("doc"),
        F.array().cast("array<string>").alias("children"),
    )
    # Customers as runs of their own, so that the table grows with the data.
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.lit(1).cast("byte").alias("type"),
        F.lit("customer").alias("doc"),
        F.array().cast("array<string>").alias("children"),
    )
    return chains.unionByName(runs).unionByName(customers)


@query(
    "chain_edges",
    f"""
    WITH {_NATION_CHAINS_SQL}
    SELECT name AS parent, CAST(position AS INTEGER) AS position, child FROM chains
    """,
)
def chain_edges_query(spark, sf_dir):
    return chain_edges(_nation_collections(spark, sf_dir))


@query(
    "collection_nodes",
    """
    SELECT DISTINCT 'r' || n_regionkey AS name, CAST(3 AS TINYINT) AS type, 'region' AS doc FROM nation
    UNION ALL SELECT n_name, CAST(1 AS TINYINT), 'nation' FROM nation
    UNION ALL SELECT c_name, CAST(1 AS TINYINT), 'customer' FROM customer
    """,
)
def collection_nodes_query(spark, sf_dir):
    return collection_nodes(_nation_collections(spark, sf_dir))


@query(
    "alias_chain",
    f"""
    WITH {_NATION_CHAINS_SQL},
    everything AS (SELECT * FROM chains UNION ALL SELECT 'alias', child, position FROM chains WHERE name = 'r2')
    SELECT name AS parent, CAST(position AS INTEGER) AS position, child FROM everything
    """,
)
def alias_chain(spark, sf_dir):
    return chain_edges(add_alias_chain(_nation_collections(spark, sf_dir), "r2", "alias"))


@query(
    "collections_by_type",
    """
    WITH names AS (
      SELECT DISTINCT 'runs/' || CAST(year(o_orderdate) AS VARCHAR) AS name, FALSE AS associated FROM orders
      UNION SELECT 'tags/' || substr(o_orderpriority, 1, 1), TRUE FROM orders
      UNION SELECT 'calibs/p', TRUE FROM orders WHERE o_orderstatus = 'P'
      UNION SELECT 'runs/raw', FALSE FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
    SELECT name, 'search' AS used_for FROM names UNION ALL SELECT name, 'associations' FROM names WHERE associated
    """,
)
def collections_by_type(spark, sf_dir):
    found = adapters.collections(spark, sf_dir)
    searched = search_collections(found).select("name", F.lit("search").alias("used_for"))
    associated = association_collections(found).select("name", F.lit("associations").alias("used_for"))
    return searched.unionByName(associated)


@query(
    "search_candidates",
    f"""
    WITH {adapters.CANDIDATES_SQL}
    SELECT dataset_id, dataset_type, run, visit, collection, CAST(search_rank AS BIGINT) AS search_rank
    FROM candidates
    """,
)
def search_candidates(spark, sf_dir):
    """Every way each dataset is reached."""
    candidates = search(
        adapters.order_datasets(spark, sf_dir),
        adapters.memberships(spark, sf_dir),
        adapters.ranked_collections(spark, sf_dir),
    )
    return candidates.select(
        binary_to_hex("dataset_id").alias("dataset_id"), "dataset_type", "run", "visit", "collection", "search_rank"
    )


@query(
    "search_find_first",
    f"""
    WITH {adapters.CANDIDATES_SQL}
    SELECT dataset_id, dataset_type, run, visit FROM found WHERE dataset_type <> 'order_p'
    """,
)
def search_find_first(spark, sf_dir):
    candidates = search(
        adapters.order_datasets(spark, sf_dir).where("dataset_type != 'order_p'"),
        adapters.memberships(spark, sf_dir),
        adapters.ranked_collections(spark, sf_dir),
    )
    best = find_first(candidates, ["dataset_type", "instrument", "visit"])
    return best.select(binary_to_hex("dataset_id").alias("dataset_id"), "dataset_type", "run", "visit")


@query(
    "find_first_events",
    """
    WITH ranks(event_type, search_rank) AS (
      VALUES ('purchase', 0), ('signup', 1), ('click', 2), ('view', 3), ('error', 4))
    SELECT event_id, user_id, event_type FROM (
      SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY search_rank, event_id) AS place
      FROM events e JOIN ranks USING (event_type))
    WHERE place = 1
    """,
)
def find_first_events(spark, sf_dir):
    """One event for each user, by type and then by age."""
    order = ["purchase", "signup", "click", "view", "error"]
    rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("event_type"))
    ranked = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", rank.alias("search_rank"))
    known = ranked.where("search_rank > 0")
    return find_first(known, ["user_id"], ["search_rank", "event_id"]).drop("search_rank")


@query(
    "search_all_calib",
    f"""
    WITH {adapters.CANDIDATES_SQL}
    SELECT dataset_id, dataset_type, run, visit FROM found WHERE dataset_type = 'order_p'
    """,
)
def search_all_calib(spark, sf_dir):
    found = search_all(
        adapters.order_datasets(spark, sf_dir).where("dataset_type = 'order_p'"),
        adapters.memberships(spark, sf_dir),
        adapters.ranked_collections(spark, sf_dir),
    )
    return found.select(binary_to_hex("dataset_id").alias("dataset_id"), "dataset_type", "run", "visit")


def _selected(spark, sf_dir):
    catalog = adapters.catalog(spark, sf_dir)
    types = catalog.dataset_types.where("name LIKE 'order%'").collect()
    ranked = adapters.ranked_collections(spark, sf_dir)
    # Stored, as by an export: runs, provenance and associations all start from what was found.
    return catalog, ranked, cut_lineage(select_datasets(catalog, types, ranked), "found")


@query(
    "extra_runs",
    f"""
    WITH {adapters.CANDIDATES_SQL}
    SELECT DISTINCT run FROM found WHERE run NOT IN (SELECT name FROM ranks)
    """,
)
def extra_runs_query(spark, sf_dir):
    _, ranked, found = _selected(spark, sf_dir)
    return extra_runs(found, ranked)


@query(
    "provenance_pass",
    f"""
    WITH {adapters.CANDIDATES_SQL},
    runs AS (SELECT DISTINCT run FROM found UNION SELECT name FROM ranks WHERE type = 1)
    SELECT DISTINCT run, 'c' || lpad(lower(hex(CAST(substr(run, 6) AS BIGINT))), 31, '0') AS dataset_id
    FROM runs WHERE run IN (SELECT run FROM order_datasets)
    """,
)
def provenance_pass(spark, sf_dir):
    """Provenance of every searched run and of every run a dataset was found in."""
    catalog, ranked, found = _selected(spark, sf_dir)
    runs = runs_found(found).select(F.col("run").alias("name"), F.lit(1).cast("byte").alias("type"))
    searched = ranked.select("name", "type").union(runs).distinct()
    provenance = catalog.datasets.where("dataset_type = 'run_provenance'")
    hits = search_all(provenance, catalog.memberships, searched)
    return hits.select("run", binary_to_hex("dataset_id").alias("dataset_id"))


@query(
    "associations",
    f"""
    WITH {adapters.CANDIDATES_SQL}
    SELECT dataset_id, run, visit, 'tags/1' AS collection, CAST(NULL AS BIGINT) AS begin_nsec,
           CAST(NULL AS BIGINT) AS end_nsec
    FROM found WHERE tag = 'tags/1'
    UNION ALL
    SELECT dataset_id, run, visit, 'calibs/p', epoch_us(o_orderdate) * 1000, epoch_us(o_orderdate) * 1000 + 86400000000000
    FROM found WHERE dataset_type = 'order_p'
    """,
)
def associations_query(spark, sf_dir):
    """Tag and calibration entries of the datasets found."""
    catalog, ranked, found = _selected(spark, sf_dir)
    entries = associations(found, catalog.memberships, ranked)
    return entries.select(
        binary_to_hex("dataset_id").alias("dataset_id"),
        "run",
        "visit",
        "collection",
        "timespan.begin_nsec",
        "timespan.end_nsec",
    )
