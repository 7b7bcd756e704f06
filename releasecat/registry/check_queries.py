"""Queries on joins, pruning and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import binary_to_hex
from ..operators.joins import (
    already_there,
    keep_matching,
    keep_matching_all,
    orphans,
    skip_existing,
)
from ..operators.ordering import sort_by
from ..operators.prune import (
    dangling_definitions,
    prune_definitions,
    prune_exposures,
    prune_visit_members,
    prune_visits,
    referenced_keys,
    remove_value,
)
from ..operators.selection import union_by_name
from ..operators.validation import (
    bad_association_collections,
    duplicate_ids,
    ids_already_loaded,
    missing_types,
    null_violations,
    paths_outside,
)
from ..plans.export import datastore_for
from . import adapters
from .base import query, table


@query(
    "assoc_filter",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, 'tag_' || l_returnflag AS collection FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    """,
)
def assoc_filter(spark, sf_dir):
    """Line items of finished orders, by collection."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("tag_"), F.col("l_returnflag")).alias("collection")
    )
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    kept = keep_matching(items, finished, {"l_orderkey": "o_orderkey"}, unique_keys=True)
    return sort_by(kept, "collection", "l_orderkey", "l_linenumber")


@query(
    "filter_cascade",
    """
    WITH wanted AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT 'orders' AS name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
    WHERE o_custkey IN (SELECT * FROM wanted)
    UNION ALL SELECT 'customers', count(*), CAST(sum(c_nationkey) AS BIGINT) FROM customer
    WHERE c_custkey IN (SELECT * FROM wanted)
    UNION ALL SELECT 'events', count(*), CAST(sum(event_id) AS BIGINT) FROM events
    WHERE user_id IN (SELECT * FROM wanted)
    """,
)
def filter_cascade(spark, sf_dir):
    """The same customers kept in three tables."""
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS id")
    tables = {
        "orders": table(spark, sf_dir, "orders").selectExpr("o_custkey AS id", "o_orderkey AS value"),
        "customers": table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_nationkey AS value"),
        "events": table(spark, sf_dir, "events").selectExpr("user_id AS id", "event_id AS value"),
    }
    kept = keep_matching_all(tables, wanted, "id", unique_keys=True)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("long").alias("keys")).select(
            F.lit(name).alias("name"), "n", "keys"
        )
        for name, df in kept.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "datastore_lookup",
    f"""
    WITH {adapters.DATASETS_SQL}
    SELECT dataset_type, dataset_id, 'store_' || lower(l_returnflag) AS datastore_name, l_partkey AS part
    FROM order_datasets JOIN lineitem ON l_orderkey = o_orderkey
    """,
)
def datastore_lookup(spark, sf_dir):
    """File records of the datasets of all types."""
    records = datastore_for(adapters.order_datasets(spark, sf_dir), adapters.datastore(spark, sf_dir))
    return records.select(
        "dataset_type",
        binary_to_hex("dataset_id").alias("dataset_id"),
        "datastore_name",
        F.regexp_extract("path", "parts/([0-9]+)", 1).cast("long").alias("part"),
    )


# Line items tie exposures (parts) to visits (orders).  Urgent orders are in data IDs as
# visits and promotional parts as exposures.
PRUNE_SQL = """
definition AS (SELECT DISTINCT l_partkey AS exposure, l_orderkey AS visit FROM lineitem),
data_visits AS (SELECT o_orderkey AS visit FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
data_exposures AS (SELECT p_partkey AS exposure FROM part WHERE p_brand = 'Brand#7'),
visits AS (
  SELECT visit FROM data_visits
  UNION SELECT visit FROM definition WHERE exposure IN (SELECT exposure FROM data_exposures)),
exposures AS (
  SELECT exposure FROM data_exposures
  UNION SELECT exposure FROM definition WHERE visit IN (SELECT visit FROM data_visits))
"""


def definition(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.lit("cam").alias("instrument"), F.col("l_partkey").alias("exposure"), F.col("l_orderkey").alias("visit")
    )


def prune_keys(spark, sf_dir):
    cam = F.lit("cam").alias("instrument")
    visits = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")
    exposures = table(spark, sf_dir, "part").where("p_brand = 'Brand#7'")
    datasets = union_by_name(
        [
            visits.select(cam, F.col("o_orderkey").alias("visit")),
            exposures.select(cam, F.col("p_partkey").alias("exposure")),
        ]
    )
    return referenced_keys(datasets, definition(spark, sf_dir))


def exposure_records(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.lit("cam").alias("instrument"), F.col("p_partkey").alias("id"), F.col("p_name").alias("obs_id")
    )


@query(
    "referenced_keys",
    f"""
    WITH {PRUNE_SQL}
    SELECT 'visit' AS kind, visit AS id FROM visits UNION ALL SELECT 'exposure', exposure FROM exposures
    """,
)
def referenced_keys_query(spark, sf_dir):
    keys = prune_keys(spark, sf_dir)
    visits = keys.visits.select(F.lit("visit").alias("kind"), F.col("visit").alias("id"))
    return visits.union(keys.exposures.select(F.lit("exposure").alias("kind"), F.col("exposure").alias("id")))


@query(
    "prune_exposure",
    f"WITH {PRUNE_SQL} SELECT 'cam' AS instrument, p_partkey AS id, p_name AS obs_id FROM part "
    "WHERE p_partkey IN (SELECT exposure FROM exposures)",
)
def prune_exposure(spark, sf_dir):
    return prune_exposures(exposure_records(spark, sf_dir), prune_keys(spark, sf_dir))


@query(
    "prune_visit",
    f"WITH {PRUNE_SQL} SELECT 'cam' AS instrument, o_orderkey AS id, o_orderpriority AS name FROM orders "
    "WHERE o_orderkey IN (SELECT visit FROM visits)",
)
def prune_visit(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        F.lit("cam").alias("instrument"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")
    )
    return prune_visits(records, prune_keys(spark, sf_dir))


@query(
    "prune_member",
    f"WITH {PRUNE_SQL} SELECT 'cam' AS instrument, l_orderkey AS visit, l_linenumber AS visit_system FROM lineitem "
    "WHERE l_orderkey IN (SELECT visit FROM visits)",
)
def prune_member(spark, sf_dir):
    members = table(spark, sf_dir, "lineitem").select(
        F.lit("cam").alias("instrument"),
        F.col("l_orderkey").alias("visit"),
        F.col("l_linenumber").alias("visit_system"),
    )
    return prune_visit_members(members, prune_keys(spark, sf_dir))


@query(
    "prune_definition",
    f"WITH {PRUNE_SQL} SELECT 'cam' AS instrument, exposure, visit FROM definition "
    "WHERE exposure IN (SELECT exposure FROM exposures) OR visit IN (SELECT visit FROM visits)",
)
def prune_definition(spark, sf_dir):
    return prune_definitions(definition(spark, sf_dir), prune_keys(spark, sf_dir))


@query(
    "dangling_definitions",
    f"WITH {PRUNE_SQL} SELECT 'cam' AS instrument, exposure, visit FROM definition "
    "WHERE visit IN (SELECT visit FROM visits) AND exposure NOT IN (SELECT exposure FROM exposures)",
)
def dangling_definitions_query(spark, sf_dir):
    """Rows kept for their visit whose exposure record is gone."""
    keys = prune_keys(spark, sf_dir)
    return dangling_definitions(
        prune_definitions(definition(spark, sf_dir), keys), prune_exposures(exposure_records(spark, sf_dir), keys)
    )


@query(
    "remove_value",
    """
    WITH kept AS (SELECT p_partkey FROM part WHERE p_brand <> 'Brand#7')
    SELECT 'records' AS name, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS checksum FROM part WHERE p_brand <> 'Brand#7'
    UNION ALL SELECT 'datasets', count(*), CAST(sum(p_partkey) AS BIGINT) FROM kept
    UNION ALL SELECT 'datastore', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem
    WHERE l_partkey IN (SELECT * FROM kept)
    """,
)
def remove_value_query(spark, sf_dir):
    """One brand removed from records, datasets and file records."""
    part = table(spark, sf_dir, "part")
    records, datasets, dependents = remove_value(
        {"records": (part.select("p_brand", F.col("p_size").alias("value")), "p_brand")},
        part.selectExpr("p_partkey AS dataset_id", "p_brand", "p_partkey AS value"),
        {"datastore": table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS dataset_id", "l_orderkey AS value")},
        "p_brand",
        "Brand#7",
    )
    counts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("long").alias("checksum")).select(
            F.lit(name).alias("name"), "n", "checksum"
        )
        for name, df in {**records, "datasets": datasets, **dependents}.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "orphans",
    """
    SELECT c_custkey, c_nationkey FROM customer
    WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (2, 3))
    """,
)
def orphans_query(spark, sf_dir):
    """Customers of nations outside two regions."""
    nations = table(spark, sf_dir, "nation").where("n_regionkey IN (2, 3)")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orphans(customers, nations, {"c_nationkey": "n_nationkey"})


def document_plan(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/texts/"), F.col("doc_id")).alias("source"),
        F.concat("source", F.lit("/"), F.col("doc_id")).alias("destination"),
    )


def document_listing(spark, sf_dir):
    """Labelled documents are at the destination already."""
    labelled = keep_matching(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return labelled.select(F.concat("source", F.lit("/"), F.col("doc_id")).alias("destination"))


_PLAN_SQL = "SELECT '/texts/' || doc_id AS source, source || '/' || doc_id AS destination FROM documents WHERE doc_id"


@query("transfer_skip", f"{_PLAN_SQL} NOT IN (SELECT doc_id FROM labels)")
def transfer_skip(spark, sf_dir):
    return skip_existing(document_plan(spark, sf_dir), document_listing(spark, sf_dir))


@query("transfer_already_there", f"{_PLAN_SQL} IN (SELECT doc_id FROM labels)")
def transfer_already_there(spark, sf_dir):
    return already_there(document_plan(spark, sf_dir), document_listing(spark, sf_dir))


@query(
    "duplicate_ids",
    "SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_ids_query(spark, sf_dir):
    return duplicate_ids(table(spark, sf_dir, "events"), "user_id", "event_type")


@query(
    "ids_already_loaded",
    "SELECT o_custkey AS id FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')",
)
def ids_already_loaded_query(spark, sf_dir):
    loaded = table(spark, sf_dir, "events").where("event_type = 'purchase'").selectExpr("user_id AS id")
    return ids_already_loaded(table(spark, sf_dir, "orders").selectExpr("o_custkey AS id"), loaded, "id")


@query(
    "bad_association_collections",
    """
    SELECT 'runs/' || CAST(year(o_orderdate) AS VARCHAR) AS collection, count(*) AS entries, CAST(1 AS TINYINT) AS type
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
    UNION ALL SELECT 'nowhere', count(*), NULL FROM orders WHERE o_orderstatus = 'P'
    """,
)
def bad_association_collections_query(spark, sf_dir):
    """Entries in runs and in a collection that does not exist."""
    orders = table(spark, sf_dir, "orders")
    places = (
        F.when(F.col("o_orderstatus") == "F", adapters.order_run())
        .when(F.col("o_orderstatus") == "P", F.lit("nowhere"))
        .otherwise(F.concat(F.lit("tags/"), F.substring("o_orderpriority", 1, 1)))
    )
    return bad_association_collections(
        orders.select(places.alias("collection")), adapters.collections(spark, sf_dir)
    )


@query(
    "paths_outside",
    """
    SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN '../up/' || p_partkey WHEN 'SMALL' THEN 'a/../../' || p_partkey
             WHEN 'LARGE' THEN '/abs/' || p_partkey END AS file
    FROM part WHERE p_type IN ('PROMO', 'SMALL', 'LARGE')
    """,
)
def paths_outside_query(spark, sf_dir):
    """Three ways to leave a directory; the other types stay inside, one of them by way of '..'."""
    key = F.col("p_partkey").cast("string")
    kind = F.col("p_type")
    file = (
        F.when(kind == "PROMO", F.concat(F.lit("../up/"), key))
        .when(kind == "SMALL", F.concat(F.lit("a/../../"), key))
        .when(kind == "LARGE", F.concat(F.lit("/abs/"), key))
        .when(kind == "MEDIUM", F.concat(F.lit("a/../b/./"), key))
        .otherwise(F.concat(F.lit("a/b//"), key))
    )
    return paths_outside(table(spark, sf_dir, "part").select("p_partkey", file.alias("file")))


@query(
    "missing_types",
    "SELECT DISTINCT p_name AS name FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size > 48)",
)
def missing_types_query(spark, sf_dir):
    """Part names that no large part has."""
    part = table(spark, sf_dir, "part")
    return missing_types(part.selectExpr("p_name AS name"), part.where("p_size > 48").selectExpr("p_name AS name"))


@query(
    "null_violations",
    """
    SELECT 'visit' AS "column", count(*) AS nulls FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'run', count(*) FROM orders WHERE o_orderpriority = '5-LOW'
    """,
)
def null_violations_query(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("dataset_id", T.LongType(), False),
            T.StructField("run", T.StringType(), False),
            T.StructField("visit", T.LongType(), False),
            T.StructField("note", T.StringType(), True),
        ]
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("dataset_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", adapters.order_run()).alias("run"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("visit"),
        F.lit(None).cast("string").alias("note"),
    )
    return null_violations(orders, schema)
