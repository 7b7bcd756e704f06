"""Queries on paths, identifiers and columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.formatting import association_file, dataset_file, datastore_file, decimal_size
from ..functions.identifiers import binary_to_hex, binary_to_uuid, or_unbounded, timespan, uuid_to_binary
from ..operators.paths import (
    file_list,
    make_paths_absolute,
    map_to_datastores,
    unknown_roots,
    unmapped_paths,
)
from ..operators.selection import (
    drop_value,
    patch_where,
    project_data_id,
    rewrite_columns,
    select_types,
    union_by_name,
    unmatched_globs,
    with_size,
    without_size,
)
from ..operators.summary import count_rows
from ..operators.transfer import assign_batches, transfer_pairs
from ..schemas import STANDARD_SPEC
from . import adapters
from .base import query, table


def event_members(spark, sf_dir):
    """One archive for each user, one member for each event."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("file:///ev/u"), F.col("user_id"), F.lit(".zip#unzip="), F.col("event_id")).alias("path")
    )


def document_paths(spark, sf_dir):
    """Documents by source: relative, or absolute for English ones."""
    relative = F.concat("lang", F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("datastore_name"),
        F.when(F.col("lang") == "en", F.concat(F.lit("s3://texts/"), relative)).otherwise(relative).alias("path"),
    )


DOCUMENT_PATHS_SQL = """
docs AS (
  SELECT doc_id, source AS datastore_name, lang,
         CASE WHEN lang = 'en' THEN 's3://texts/' ELSE '' END || lang || '/' || doc_id || '.txt' AS path
  FROM documents)
"""

# Roots of all twenty sources; even ones end with a slash.
SOURCE_ROOTS = {f"src{n}": f"file:///store/{n}{'/' if n % 2 == 0 else ''}" for n in range(20)}
# The short first prefix wins over the longer ones after it; "http://b" ends inside a host name.
URL_PREFIXES = {
    "https://": "secure",
    "https://blog.": "never",
    "http://b": "b_hosts",
    "http://www.": "www",
    "http://": "plain",
}


@query(
    "file_list_distinct",
    """
    SELECT DISTINCT split_part(path, '#', 1) AS file FROM (
      SELECT 'file:///ev/u' || user_id || '.zip#unzip=' || event_id AS path FROM events
      UNION ALL SELECT url FROM pages)
    """,
)
def file_list_distinct(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return file_list(event_members(spark, sf_dir), pages)


@query(
    "file_batches",
    """
    WITH files AS (SELECT DISTINCT split_part(url, '#', 1) AS file FROM pages)
    SELECT file, CAST(floor((row_number() OVER (ORDER BY file) - 1) / 5) AS BIGINT) AS batch FROM files
    """,
)
def file_batches(spark, sf_dir):
    files = file_list(table(spark, sf_dir, "pages").select(F.col("url").alias("path")))
    return assign_batches(files, 5, key="file")


@query(
    "absolute_paths",
    f"""
    WITH {DOCUMENT_PATHS_SQL}
    SELECT doc_id, datastore_name,
           CASE WHEN lang = 'en' THEN path ELSE 'file:///store/' || substr(datastore_name, 4) || '/' || path END AS path
    FROM docs
    """,
)
def absolute_paths(spark, sf_dir):
    return make_paths_absolute(document_paths(spark, sf_dir), SOURCE_ROOTS)


@query(
    "absolute_paths_by_table",
    f"""
    WITH {DOCUMENT_PATHS_SQL}
    SELECT doc_id, datastore_name,
           CASE WHEN lang = 'en' THEN path ELSE 's3://' || datastore_name || '/' || path END AS path
    FROM docs
    """,
)
def absolute_paths_by_table(spark, sf_dir):
    docs = document_paths(spark, sf_dir)
    roots = docs.select("datastore_name").distinct()
    roots = roots.withColumn("root", F.concat(F.lit("s3://"), "datastore_name", F.lit("/")))
    return make_paths_absolute(docs, roots).select("doc_id", "datastore_name", "path")


@query(
    "unknown_roots",
    f"""
    WITH {DOCUMENT_PATHS_SQL}
    SELECT doc_id, datastore_name, path FROM docs WHERE lang <> 'en' AND datastore_name IN ('src3', 'src12')
    """,
)
def unknown_roots_query(spark, sf_dir):
    known = {name: root for name, root in SOURCE_ROOTS.items() if name not in ("src3", "src12")}
    return unknown_roots(document_paths(spark, sf_dir), known)


@query(
    "map_datastores",
    """
    SELECT page_id,
           CASE WHEN starts_with(url, 'https://') THEN 'secure' WHEN starts_with(url, 'http://b') THEN 'b_hosts'
                WHEN starts_with(url, 'http://www.') THEN 'www' WHEN starts_with(url, 'http://') THEN 'plain'
           END AS datastore_name,
           ltrim(CASE WHEN starts_with(url, 'https://') THEN substr(url, 9)
                      WHEN starts_with(url, 'http://b') THEN substr(url, 9)
                      WHEN starts_with(url, 'http://www.') THEN substr(url, 12)
                      WHEN starts_with(url, 'http://') THEN substr(url, 8) END, '/') AS path
    FROM pages
    """,
)
def map_datastores(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return map_to_datastores(pages, URL_PREFIXES).select("page_id", "datastore_name", "path")


@query(
    "map_datastores_by_table",
    """
    WITH hosts AS (
      SELECT regexp_extract(url, '^[^:]+://[^/]*') AS prefix, min(page_id) AS position FROM pages GROUP BY 1),
    fits AS (
      SELECT page_id, url, prefix,
             row_number() OVER (PARTITION BY page_id ORDER BY position) AS place
      FROM pages JOIN hosts ON starts_with(url, prefix))
    SELECT page_id, 'host ' || prefix AS datastore_name, ltrim(substr(url, length(prefix) + 1), '/') AS path
    FROM fits WHERE place = 1
    """,
)
def map_datastores_by_table(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    hosts = pages.groupBy(F.regexp_extract("url", "^[^:]+://[^/]*", 0).alias("prefix")).agg(
        F.min("page_id").alias("position")
    )
    mapping = hosts.withColumn("datastore_name", F.concat(F.lit("host "), "prefix"))
    uris = pages.select("page_id", F.col("url").alias("path"))
    return map_to_datastores(uris, mapping).select("page_id", "datastore_name", "path")


@query(
    "map_datastores_many",
    """
    WITH paths AS (
      SELECT o_orderkey, 'f' || md5(CAST(o_orderkey AS VARCHAR)) || md5(CAST(o_custkey AS VARCHAR)) AS path FROM orders),
    mapping AS (
      SELECT substr(path, 1, 5 + CAST(o_orderkey % 40 AS INTEGER)) AS prefix, min(o_orderkey) AS position FROM paths GROUP BY 1),
    fits AS (
      SELECT o_orderkey, path, prefix, position, row_number() OVER (PARTITION BY o_orderkey ORDER BY position) AS place
      FROM paths CROSS JOIN (SELECT unnest(range(5, 45)) AS cut)
      JOIN mapping ON prefix = substr(path, 1, CAST(cut AS INTEGER)) AND length(prefix) = cut)
    SELECT o_orderkey, 'n' || position AS datastore_name, substr(path, length(prefix) + 1) AS path FROM fits WHERE place = 1
    """,
)
def map_datastores_many(spark, sf_dir):
    """A prefix for each order, of 40 lengths: all are searched at once, and records stay where they are."""
    orders = table(spark, sf_dir, "orders")
    path = F.concat(F.lit("f"), F.md5(F.col("o_orderkey").cast("string").cast("binary")), F.md5(F.col("o_custkey").cast("string").cast("binary")))
    paths = orders.select("o_orderkey", path.alias("path"))
    mapping = paths.select(
        F.substring("path", F.lit(1), 5 + F.pmod("o_orderkey", F.lit(40)).cast("int")).alias("prefix"),
        F.col("o_orderkey").alias("position"),
        F.concat(F.lit("n"), "o_orderkey").alias("datastore_name"),
    )
    return map_to_datastores(paths, mapping).select("o_orderkey", "datastore_name", "path")


@query(
    "unmapped_paths",
    "SELECT page_id, url FROM pages WHERE NOT starts_with(url, 'https://') AND NOT starts_with(url, 'http://www.')",
)
def unmapped_paths_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return unmapped_paths(pages, {"https://": "secure", "http://www.": "www"}, path="url")


@query(
    "transfer_pairs",
    """
    WITH files AS (SELECT DISTINCT 'file:///ev/u' || user_id || '.zip' AS file FROM events)
    SELECT substr(file, 8) AS source, 'events/' || substr(file, 12) AS destination FROM files
    """,
)
def transfer_pairs_query(spark, sf_dir):
    return transfer_pairs(file_list(event_members(spark, sf_dir)), {"s3://x": "other", "file:///ev": "events"})


@query(
    "size_text",
    """
    WITH sizes AS (SELECT doc_id, n_chars * n_chars * n_chars AS size FROM documents)
    SELECT doc_id, CASE
      WHEN size = 1 THEN '1 byte' WHEN size < 1000 THEN size || ' bytes'
      WHEN size < 1000000 THEN printf('%.1f kB', size / 1e3) WHEN size < 1000000000 THEN printf('%.1f MB', size / 1e6)
      WHEN size < 1000000000000 THEN printf('%.1f GB', size / 1e9)
      WHEN size < 1000000000000000 THEN printf('%.1f TB', size / 1e12)
      ELSE printf('%.1f PB', size / 1e15) END AS size_text
    FROM sizes
    """,
)
def size_text(spark, sf_dir):
    size = F.col("n_chars") * F.col("n_chars") * F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", decimal_size(size).alias("size_text"))


@query(
    "file_names",
    """
    SELECT p_partkey, p_type || '.datasets.parquet' AS datasets, p_type || '.datastore.parquet' AS datastore,
           p_type || '.association.parquet' AS association
    FROM part
    """,
)
def file_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        dataset_file("p_type").alias("datasets"),
        datastore_file("p_type").alias("datastore"),
        association_file("p_type").alias("association"),
    )


@query(
    "uuid_text",
    """
    WITH ids AS (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS digits FROM orders)
    SELECT o_orderkey, digits, substr(digits, 1, 8) || '-' || substr(digits, 9, 4) || '-' || substr(digits, 13, 4)
           || '-' || substr(digits, 17, 4) || '-' || substr(digits, 21) AS uuid
    FROM ids
    """,
)
def uuid_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    ids = orders.select("o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("digits"))
    stored = ids.withColumn("uuid", binary_to_uuid(uuid_to_binary("digits")))
    return stored.select("o_orderkey", binary_to_hex(uuid_to_binary("uuid")).alias("digits"), "uuid")


@query(
    "timespan_default",
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS begin_nsec,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN user_id + event_id END AS end_nsec
    FROM events
    """,
)
def timespan_default(spark, sf_dir):
    """Errors have no time span and sign-ups have an open end."""
    span = timespan(
        F.col("user_id"), F.when(F.col("event_type") != "signup", F.col("user_id") + F.col("event_id"))
    )
    events = table(spark, sf_dir, "events").withColumn(
        "timespan", or_unbounded(F.when(F.col("event_type") != "error", span))
    )
    return events.select("event_id", "timespan.begin_nsec", "timespan.end_nsec")


@query(
    "glob_types",
    r"""
    SELECT p_partkey, p_name FROM part
    WHERE regexp_full_match(p_name, '.* w.dget|[hs].* (gear|ring)|[^a-n]ed bolt|b.ue rod')
    """,
)
def glob_types(spark, sf_dir):
    globs = ["* w?dget", "[hs]* gear", "[hs]* ring", "[!a-n]ed bolt", "b?ue rod"]
    return select_types(table(spark, sf_dir, "part").select("p_partkey", "p_name"), globs, "p_name")


@query(
    "unmatched_globs",
    """
    SELECT pattern FROM (VALUES ('* ring', '% ring'), ('fish*', 'fish%'), ('RED *', 'RED %'), ('?ed *', '_ed %'))
      AS wanted(pattern, pattern_like)
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_name LIKE pattern_like)
    """,
)
def unmatched_globs_query(spark, sf_dir):
    return unmatched_globs(table(spark, sf_dir, "part"), ["* ring", "fish*", "RED *", "?ed *"], "p_name")


@query(
    "patch_where",
    """
    SELECT p_partkey, p_brand, CASE WHEN p_brand IN ('Brand#4', 'Brand#7') THEN 'SPECIAL' ELSE p_type END AS p_type
    FROM part
    """,
)
def patch_where_query(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return patch_where(parts, "p_brand", ["Brand#4", "Brand#7"], "p_type", "SPECIAL")


@query(
    "drop_value",
    """
    SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
    WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
    """,
)
def drop_value_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    return drop_value(customers, "segment", "MACHINERY")


@query(
    "size_partition",
    """
    SELECT CASE WHEN l_returnflag <> 'N' THEN 'known' ELSE 'unknown' END AS size, count(*) AS n FROM lineitem GROUP BY 1
    """,
)
def size_partition(spark, sf_dir):
    records = adapters.datastore(spark, sf_dir)
    known = count_rows(with_size(records)).select(F.lit("known").alias("size"), "n")
    return known.union(count_rows(without_size(records)).select(F.lit("unknown").alias("size"), "n"))


@query(
    "union_by_name",
    """
    SELECT c_nationkey AS nation, c_custkey AS customer, CAST(NULL AS BIGINT) AS supplier,
           CAST(NULL AS BIGINT) AS part FROM customer
    UNION ALL SELECT s_nationkey, NULL, s_suppkey, NULL FROM supplier
    UNION ALL SELECT NULL, NULL, NULL, p_partkey FROM part
    """,
)
def union_by_name_query(spark, sf_dir):
    return union_by_name(
        [
            table(spark, sf_dir, "customer").selectExpr("c_nationkey AS nation", "c_custkey AS customer"),
            table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey AS supplier"),
            table(spark, sf_dir, "part").selectExpr("p_partkey AS part"),
        ]
    )


def _host_first(rows: list[dict]) -> None:
    for row in rows:
        _, _, rest = row["path"].partition("://")
        row["datastore_name"], _, row["path"] = rest.partition("/")


@query(
    "rewrite_columns",
    """
    WITH rests AS (SELECT page_id, substr(url, position('://' IN url) + 3) AS rest FROM pages)
    SELECT page_id, split_part(rest, '/', 1) AS datastore_name,
           CASE WHEN rest LIKE '%/%' THEN substr(rest, position('/' IN rest) + 1) ELSE '' END AS path
    FROM rests
    """,
)
def rewrite_columns_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.lit("web").alias("datastore_name"), F.col("url").alias("path")
    )
    return rewrite_columns(pages, _host_first)


@query(
    "data_id_projection",
    f"""
    WITH {adapters.DATASETS_SQL}
    SELECT dataset_id, run, instrument, visit FROM order_datasets
    """,
)
def data_id_projection(spark, sf_dir):
    projected = project_data_id(adapters.order_datasets(spark, sf_dir), STANDARD_SPEC, ["visit"])
    return projected.withColumn("dataset_id", binary_to_hex("dataset_id"))
