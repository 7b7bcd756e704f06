"""Queries that count and sum."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordering import row_index
from ..operators.paths import file_list
from ..operators.progress import fold_progress, overall_progress
from ..operators.summary import (
    collection_units,
    count_files,
    count_rows,
    distinct_keys,
    files_without_size,
    footer_count_report,
    known_size,
    listed_size,
    release_summary,
    run_units,
    type_count_report,
)
from ..operators.joins import fill_sizes
from ..operators.transfer import running_transfer_totals, transfer_totals
from ..streaming.progress import read_events, read_progress, write_progress
from ..session import staging_path
from ..sources.listing import file_sizes, list_files
from . import adapters
from .base import SCHEMAS, query, table, table_path

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def typed_records(spark, sf_dir):
    """File records of the orders with their dataset type."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order"), F.concat(F.lit("order_"), F.lower("o_orderstatus")).alias("dataset_type")
    )
    return adapters.datastore(spark, sf_dir, "l_orderkey").join(
        orders, F.col("l_orderkey") == F.col("order")
    ).drop("l_orderkey", "order")


def part_listing(spark, sf_dir):
    """Size of every part's archive in both places."""
    part = table(spark, sf_dir, "part")
    archive = F.concat(F.lit("parts/"), F.col("p_partkey"), F.lit(".zip"))
    places = F.explode(F.array(archive, F.concat(F.lit("file:///archive/"), archive)))
    return part.select(places.alias("file"), (F.col("p_size").cast("long") * 1_000_000).alias("size"))


def listed_parts(spark, sf_dir):
    """The same without promotional parts."""
    part = table(spark, sf_dir, "part").where("p_type != 'PROMO'").select("p_partkey")
    partkey = F.regexp_extract("file", "parts/([0-9]+)", 1).cast("long")
    return part_listing(spark, sf_dir).join(part, partkey == part["p_partkey"], "left_semi")


RECORDS_SQL = """
records AS (
  SELECT 'order_' || lower(o_orderstatus) AS dataset_type,
         CASE WHEN l_linestatus = 'O' THEN 'file:///archive/' ELSE '' END || 'parts/' || l_partkey || '.zip' AS file,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) * 1000 END AS file_size,
         p_size * CAST(1000000 AS BIGINT) AS listed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
known AS (SELECT dataset_type, sum(file_size) AS bytes, count(DISTINCT file) AS files FROM records GROUP BY 1),
unknown AS (
  SELECT dataset_type, sum(listed) AS bytes
  FROM (SELECT DISTINCT dataset_type, file, listed FROM records WHERE file_size IS NULL) GROUP BY 1)
"""


@query(
    "release_summary",
    f"""
    WITH {RECORDS_SQL},
    counted AS (
      SELECT 'order_' || lower(o_orderstatus) AS dataset_type, count(*) AS datasets FROM orders GROUP BY 1),
    totals AS (
      SELECT dataset_type, datasets, files, CAST(known.bytes + unknown.bytes AS BIGINT) AS bytes
      FROM counted JOIN known USING (dataset_type) JOIN unknown USING (dataset_type))
    SELECT dataset_type, datasets, files, bytes, CASE
      WHEN bytes < 1000000000 THEN printf('%.1f MB', bytes / 1e6)
      WHEN bytes < 1000000000000 THEN printf('%.1f GB', bytes / 1e9)
      ELSE printf('%.1f TB', bytes / 1e12) END AS size
    FROM totals
    """,
)
def release_summary_query(spark, sf_dir):
    summary = release_summary(
        adapters.order_datasets(spark, sf_dir), typed_records(spark, sf_dir), part_listing(spark, sf_dir)
    )
    return summary.withColumn("bytes", F.col("bytes").cast("long")).drop("files_without_size")


@query(
    "summary_of_files",
    """
    WITH records AS (
      SELECT 'order_' || lower(o_orderstatus) AS dataset_type,
             CASE WHEN l_linestatus = 'O' THEN 'file:///archive/' ELSE '' END || 'parts/' || l_partkey || '.zip' AS file,
             CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) * 1000 END AS file_size,
             CASE WHEN p_type <> 'PROMO' THEN p_size * CAST(1000000 AS BIGINT) END AS listed
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
    known AS (SELECT dataset_type, sum(file_size) AS bytes, count(DISTINCT file) AS files FROM records GROUP BY 1),
    unknown AS (
      SELECT dataset_type, sum(listed) AS bytes, count(*) FILTER (listed IS NULL) AS files_without_size
      FROM (SELECT DISTINCT dataset_type, file, listed FROM records WHERE file_size IS NULL) GROUP BY 1)
    SELECT dataset_type, files, CAST(coalesce(known.bytes, 0) + coalesce(unknown.bytes, 0) AS BIGINT) AS bytes,
           coalesce(files_without_size, 0) AS files_without_size
    FROM known LEFT JOIN unknown USING (dataset_type)
    """,
)
def summary_of_files(spark, sf_dir):
    """Bytes where a size is known, and how many files have none: promotional parts are not listed."""
    records = typed_records(spark, sf_dir)
    summary = release_summary(adapters.order_datasets(spark, sf_dir), records, listed_parts(spark, sf_dir))
    return summary.select("dataset_type", "files", F.col("bytes").cast("long").alias("bytes"), "files_without_size")


@query(
    "listed_files",
    "SELECT p_size, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS bytes FROM part GROUP BY p_size",
)
def listed_files(spark, sf_dir):
    """Sizes of files that hold the names of the parts, one folder for each size of part, as tasks list them."""
    folder = staging_path(spark, "part-names")
    table(spark, sf_dir, "part").select("p_size", "p_name").write.partitionBy("p_size").text(folder)
    size = F.regexp_extract("file", "p_size=([0-9]+)/", 1).cast("int")
    return list_files(spark, folder, "*.txt").groupBy(size.alias("p_size")).agg(F.sum("size").alias("bytes"))


@query(
    "asked_sizes",
    "SELECT p_size, CAST(sum(strlen(p_name) + 1) AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS absent FROM part GROUP BY p_size",
)
def asked_sizes(spark, sf_dir):
    """The same sizes asked for file by file, with one name in each folder that is no file."""
    folder = staging_path(spark, "part-names")
    table(spark, sf_dir, "part").select("p_size", "p_name").write.partitionBy("p_size").text(folder)
    found = list_files(spark, folder).select("file")
    none = found.select(F.concat(F.regexp_replace("file", "[^/]*$", ""), F.lit("none.txt")).alias("file")).distinct()
    size = F.regexp_extract("file", "p_size=([0-9]+)/", 1).cast("int").alias("p_size")
    return file_sizes(found.union(none)).groupBy(size).agg(
        F.sum("size").alias("bytes"), F.count_if(F.col("size").isNull()).alias("absent")
    )


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return count_rows(adapters.datastore(spark, sf_dir))


@query("file_count", f"WITH {RECORDS_SQL} SELECT dataset_type, count(DISTINCT file) AS files FROM records GROUP BY 1")
def file_count(spark, sf_dir):
    return count_files(typed_records(spark, sf_dir), "dataset_type")


@query("known_size", f"WITH {RECORDS_SQL} SELECT dataset_type, CAST(bytes AS BIGINT) AS bytes FROM known")
def known_size_query(spark, sf_dir):
    sizes = known_size(typed_records(spark, sf_dir), "dataset_type")
    return sizes.withColumn("bytes", F.col("bytes").cast("long"))


@query("listed_size", f"WITH {RECORDS_SQL} SELECT dataset_type, CAST(bytes AS BIGINT) AS bytes FROM unknown")
def listed_size_query(spark, sf_dir):
    sizes = listed_size(typed_records(spark, sf_dir), part_listing(spark, sf_dir), "dataset_type")
    return sizes.withColumn("bytes", F.col("bytes").cast("long"))


@query(
    "fill_sizes",
    """
    SELECT DISTINCT CASE WHEN l_linestatus = 'O' THEN 'file:///archive/' ELSE '' END || 'parts/' || l_partkey || '.zip'
             AS file,
           CASE WHEN p_type <> 'PROMO' THEN p_size * CAST(1000000 AS BIGINT) END AS size
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N'
    """,
)
def fill_sizes_query(spark, sf_dir):
    """Sizes of files without one; promotional parts are not in the listing."""
    listing = listed_parts(spark, sf_dir)
    return fill_sizes(files_without_size(adapters.datastore(spark, sf_dir)), listing)


@query("distinct_keys", "SELECT DISTINCT 'cam' AS instrument, o_custkey AS visit FROM orders")
def distinct_keys_query(spark, sf_dir):
    return distinct_keys(adapters.order_datasets(spark, sf_dir), "instrument", "visit")


@query(
    "count_report",
    " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n_rows FROM {name}" for name in _TABLES),
)
def count_report_query(spark, sf_dir):
    return footer_count_report(spark, {name: table_path(sf_dir, name) for name in _TABLES}, SCHEMAS)


@query(
    "type_count_report",
    f"""
    WITH {adapters.DATASETS_SQL},
    items AS (SELECT o_orderkey, dataset_type, count(*) AS n FROM order_datasets JOIN lineitem ON l_orderkey = o_orderkey
              GROUP BY 1, 2)
    SELECT dataset_type, count(*) AS datasets, CAST(coalesce(sum(n), 0) AS BIGINT) AS datastore_records,
           CAST(count(*) + count(*) FILTER (dataset_type = 'order_p') AS BIGINT) AS associations
    FROM order_datasets LEFT JOIN items USING (o_orderkey, dataset_type) GROUP BY 1
    UNION ALL SELECT name, 0, 0, 0 FROM (VALUES ('raw'), ('run_provenance'), ('sky_map')) AS empty(name)
    """,
)
def type_count_report_query(spark, sf_dir):
    datasets = adapters.order_datasets(spark, sf_dir)
    entries = adapters.memberships(spark, sf_dir).join(datasets.select("dataset_id", "dataset_type"), "dataset_id")
    return type_count_report(adapters.dataset_types(spark), datasets, typed_records(spark, sf_dir), entries)


@query(
    "load_by_run",
    f"WITH {adapters.DATASETS_SQL} SELECT dataset_type, run, count(*) AS datasets FROM order_datasets GROUP BY 1, 2",
)
def load_by_run(spark, sf_dir):
    return run_units(adapters.order_datasets(spark, sf_dir))


@query(
    "assoc_by_collection",
    f"""
    WITH {adapters.DATASETS_SQL}
    SELECT tag AS collection, CAST(2 AS TINYINT) AS type, count(*) AS entries, count(*) AS unbounded
    FROM order_datasets GROUP BY 1
    UNION ALL SELECT 'calibs/p', CAST(4 AS TINYINT), count(*), 0 FROM order_datasets WHERE dataset_type = 'order_p'
    """,
)
def assoc_by_collection(spark, sf_dir):
    return collection_units(adapters.memberships(spark, sf_dir), adapters.collections(spark, sf_dir))


def transfer_results(spark, sf_dir):
    """Orders as finished batches: line items sent or, when returned, skipped."""
    returned = F.col("l_returnflag") == "R"
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("batch"))
        .agg(
            F.max("l_shipdate").alias("finished"),
            F.count_if(~returned).alias("uploaded"),
            F.count_if(returned).alias("skipped"),
        )
    )


RESULTS_SQL = """
results AS (
  SELECT l_orderkey AS batch, max(l_shipdate) AS finished, count(*) FILTER (l_returnflag <> 'R') AS uploaded,
         count(*) FILTER (l_returnflag = 'R') AS skipped
  FROM lineitem GROUP BY 1)
"""


@query(
    "transfer_totals",
    f"""
    WITH {RESULTS_SQL}
    SELECT CAST(sum(uploaded) AS BIGINT) AS uploaded, CAST(sum(skipped) AS BIGINT) AS skipped,
           CAST(sum(uploaded + skipped) AS BIGINT) AS total FROM results
    """,
)
def transfer_totals_query(spark, sf_dir):
    return transfer_totals(transfer_results(spark, sf_dir))


@query(
    "transfer_running_total",
    f"""
    WITH {RESULTS_SQL}
    SELECT batch, uploaded, skipped,
           CAST(sum(uploaded + skipped) OVER (ORDER BY finished, batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
    FROM results
    """,
)
def transfer_running_total(spark, sf_dir):
    totals = running_transfer_totals(transfer_results(spark, sf_dir), ["finished", "batch"])
    return totals.select("batch", "uploaded", "skipped", "total")


@query(
    "sort_nulls_last",
    """
    SELECT o_orderkey, row_number() OVER (
             ORDER BY nullif(o_orderstatus, 'F') NULLS LAST, o_custkey, o_orderkey) - 1 AS place
    FROM orders
    """,
)
def sort_nulls_last(spark, sf_dir):
    """Place of each order in a total order with missing values at its end."""
    orders = table(spark, sf_dir, "orders").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("F")))
    columns = orders.select("o_orderkey", "o_custkey", "status")
    return row_index(columns, ["status", "o_custkey", "o_orderkey"], "place").select("o_orderkey", "place")


def progress_events(spark, sf_dir):
    """Users' events as those of loads, one load for each user."""
    kinds = {"signup": "started", "click": "progress", "view": "progress", "purchase": "completed"}
    event = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in kinds.items()])
    return table(spark, sf_dir, "events").select(
        event.alias("event"),
        F.concat(F.lit("type_"), F.col("user_id")).alias("dataset_type"),
        F.when(event == "started", F.floor(F.col("value") * 100).cast("long")).alias("total_datasets"),
        F.when(event == "progress", F.floor("value").cast("long")).alias("datasets_imported"),
    )


PROGRESS_SQL = """
progress AS (
  SELECT 'type_' || user_id AS dataset_type,
         coalesce(max(CAST(floor(value * 100) AS BIGINT)) FILTER (event_type = 'signup'), 0) AS total,
         CAST(coalesce(sum(CAST(floor(value) AS BIGINT)) FILTER (event_type IN ('click', 'view')), 0) AS BIGINT)
           AS imported,
         CASE WHEN bool_or(event_type = 'purchase') THEN 'complete' ELSE 'working' END AS status
  FROM events GROUP BY 1)
"""


@query("progress_fold", f"WITH {PROGRESS_SQL} SELECT * FROM progress")
def progress_fold(spark, sf_dir):
    return fold_progress(progress_events(spark, sf_dir))


@query(
    "progress_overall",
    f"""
    WITH {PROGRESS_SQL}
    SELECT count(*) FILTER (status = 'complete') AS completed_types, count(*) AS total_types,
           CAST(sum(imported) AS BIGINT) AS imported
    FROM progress
    """,
)
def progress_overall(spark, sf_dir):
    return overall_progress(fold_progress(progress_events(spark, sf_dir)))


@query("progress_stream", f"WITH {PROGRESS_SQL} SELECT * FROM progress")
def progress_stream(spark, sf_dir):
    """The same fold as a stream over event files, a file at a time, so that most types change in several triggers."""
    source, target = staging_path(spark, "events"), staging_path(spark, "folded")
    progress_events(spark, sf_dir).repartition(3).write.parquet(source)
    write_progress(read_events(spark, source, 1), target, by_type=False).awaitTermination()
    return read_progress(spark, target)


@query(
    "member_file_count",
    "SELECT count(DISTINCT 'u' || user_id) AS n FROM events",
)
def member_file_count(spark, sf_dir):
    """Physical files behind all events."""
    path = F.concat(F.lit("u"), F.col("user_id"), F.lit("#"), F.col("event_id")).alias("path")
    return count_rows(file_list(table(spark, sf_dir, "events").select(path)))
