"""Queries on a release that is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.identifiers import binary_to_hex
from ..operators.joins import keep_missing
from ..operators.paths import map_to_datastores
from ..operators.selection import union_by_name
from ..operators.summary import count_report
from ..plans.export import export_release
from ..plans.load import dataset_orphans, load_release, record_orphans, reference_report, stray_rows
from ..plans.summary import dataset_counts, dimension_counts, summarize
from ..plans.transfer import transfer_plan
from ..plans.transform import change_storage_class, prune_release, remove_value_from_release
from ..session import staging_path
from ..sinks.rewrite import rewrite_tables
from ..sources.release import Release, manifest_types
from . import adapters
from .base import query, table

TYPES = ["order_?", "raw", "sky_map"]


def write_release(spark, sf_dir) -> Release:
    return export_release(
        adapters.catalog(spark, sf_dir), staging_path(spark, "release"), TYPES, ["run_provenance"], ["release"]
    )


def exported(spark, sf_dir) -> Release:
    """A release of these tables, written for the query that reads it."""
    return write_release(spark, sf_dir)


RELEASE_SQL = f"""
{adapters.CANDIDATES_SQL},
release_runs AS (SELECT DISTINCT run AS name FROM found UNION SELECT name FROM ranks WHERE type = 1),
provenance AS (
  SELECT DISTINCT run, 'c' || lpad(lower(hex(CAST(substr(run, 6) AS BIGINT))), 31, '0') AS dataset_id
  FROM order_datasets WHERE run IN (SELECT name FROM release_runs)),
released AS (
  SELECT dataset_type, dataset_id, run, visit, CAST(NULL AS BIGINT) AS exposure, CAST(NULL AS VARCHAR) AS skymap
  FROM found
  UNION ALL SELECT 'raw', dataset_id, run, NULL, exposure, NULL FROM raw_datasets
  UNION ALL SELECT 'run_provenance', dataset_id, run, NULL, NULL, NULL FROM provenance
  UNION ALL SELECT 'sky_map', 'd' || lpad(lower(hex(r_regionkey)), 31, '0'), 'runs/2001', NULL, NULL, r_name
  FROM region),
release_records AS (
  SELECT dataset_type, dataset_id, l_partkey, l_orderkey,
         'store_' || lower(l_returnflag) AS datastore_name,
         CASE WHEN l_linestatus = 'O' THEN 'file:///archive/' ELSE CASE l_returnflag
           WHEN 'A' THEN 'file:///data/a/' WHEN 'N' THEN 'file:///data/n/' ELSE 's3://bucket-r/' END END
         || 'parts/' || l_partkey || '.zip' AS file,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) * 1000 END AS file_size
  FROM found JOIN lineitem ON l_orderkey = o_orderkey)
"""


@query(
    "export_datasets",
    f"WITH {RELEASE_SQL} SELECT dataset_type, dataset_id, run, visit, exposure, skymap FROM released",
)
def export_datasets(spark, sf_dir):
    """All datasets of the written release: find-first, calibrations and provenance."""
    datasets = exported(spark, sf_dir).read_all_datasets()
    return datasets.select(
        "dataset_type", binary_to_hex("dataset_id").alias("dataset_id"), "run", "visit", "exposure", "skymap"
    )


@query("pruned_ids", f"WITH {RELEASE_SQL} SELECT dataset_type, dataset_id FROM released")
def pruned_ids(spark, sf_dir):
    """Ids of every type, from scans that read no other column."""
    release = exported(spark, sf_dir)
    ids = [release.read_dataset_ids(t["name"]).withColumn("dataset_type", F.lit(t["name"])) for t in release.types]
    return union_by_name(ids).select("dataset_type", binary_to_hex("dataset_id").alias("dataset_id"))


@query(
    "export_datastore",
    f"""
    WITH {RELEASE_SQL}
    SELECT dataset_type, dataset_id, datastore_name, file || '#unzip=' || l_orderkey AS path, file_size
    FROM release_records
    """,
)
def export_datastore(spark, sf_dir):
    """File records of the written release, all paths absolute."""
    records = exported(spark, sf_dir).read_all_datastore()
    return records.select(
        "dataset_type", binary_to_hex("dataset_id").alias("dataset_id"), "datastore_name", "path", "file_size"
    )


@query(
    "export_associations",
    f"""
    WITH {RELEASE_SQL}
    SELECT dataset_type, dataset_id, run, visit, 'tags/1' AS collection, CAST(NULL AS BIGINT) AS begin_nsec
    FROM found WHERE tag = 'tags/1'
    UNION ALL SELECT dataset_type, dataset_id, run, visit, 'calibs/p', epoch_us(o_orderdate) * 1000
    FROM found WHERE dataset_type = 'order_p'
    """,
)
def export_associations(spark, sf_dir):
    entries = exported(spark, sf_dir).read_all_associations()
    return entries.select(
        "dataset_type",
        binary_to_hex("dataset_id").alias("dataset_id"),
        "run",
        "visit",
        "collection",
        "timespan.begin_nsec",
    )


@query(
    "export_collections",
    f"""
    WITH {RELEASE_SQL}
    SELECT name, CAST(type AS TINYINT) AS type FROM ranks UNION SELECT name, CAST(1 AS TINYINT) FROM release_runs
    """,
)
def export_collections(spark, sf_dir):
    """Searched collections and the runs found through tags and calibrations."""
    return exported(spark, sf_dir).read_collections().select("name", "type")


@query(
    "export_manifest_types",
    f"""
    WITH {RELEASE_SQL}
    SELECT dataset_type AS name, CASE WHEN dataset_type LIKE 'order%' THEN 'instrument,visit'
             WHEN dataset_type = 'raw' THEN 'instrument,exposure' WHEN dataset_type = 'sky_map' THEN 'skymap'
             ELSE '' END AS dimensions,
           dataset_type = 'order_p' AS "isCalibration", dataset_type || '.datasets.parquet' AS dataset_export_file,
           count(*) AS datasets
    FROM released GROUP BY dataset_type
    """,
)
def export_manifest_types(spark, sf_dir):
    """Dataset types as the manifest lists them, with the datasets in their files."""
    release = exported(spark, sf_dir)
    counts = release.read_all_datasets().groupBy(F.col("dataset_type").alias("name")).count()
    types = manifest_types(release.manifest).join(counts, "name")
    return types.select(
        "name",
        F.array_join("dimensions", ",").alias("dimensions"),
        "isCalibration",
        "dataset_export_file",
        F.col("count").alias("datasets"),
    )


@query(
    "export_visit_records",
    "SELECT 'cam' AS instrument, c_custkey AS id, c_name AS name FROM customer",
)
def export_visit_records(spark, sf_dir):
    return exported(spark, sf_dir).read_dimension("visit").select("instrument", "id", "name")


@query(
    "dimension_counts",
    """
    SELECT 'instrument' AS name, CAST(1 AS BIGINT) AS n_rows UNION ALL SELECT 'visit', count(*) FROM customer
    UNION ALL SELECT 'exposure', count(*) FROM orders UNION ALL SELECT 'visit_definition', count(*) FROM orders
    UNION ALL SELECT 'visit_system_membership', count(*) FROM customer
    UNION ALL SELECT 'visit_detector_region', count(*) FROM customer
    UNION ALL SELECT 'skymap', count(*) FROM region UNION ALL SELECT 'tract', count(*) FROM nation
    """,
)
def dimension_counts_query(spark, sf_dir):
    return dimension_counts(exported(spark, sf_dir))


@query(
    "dataset_counts",
    f"""
    WITH {RELEASE_SQL},
    datasets AS (SELECT dataset_type, count(*) AS datasets FROM released GROUP BY 1),
    records AS (SELECT dataset_type, count(*) AS n FROM release_records GROUP BY 1),
    entries AS (
      SELECT dataset_type, count(*) FILTER (tag = 'tags/1') + count(*) FILTER (dataset_type = 'order_p') AS n
      FROM found GROUP BY 1)
    SELECT dataset_type, datasets, coalesce(records.n, 0) AS datastore_records, coalesce(entries.n, 0) AS associations
    FROM datasets LEFT JOIN records USING (dataset_type) LEFT JOIN entries USING (dataset_type)
    """,
)
def dataset_counts_query(spark, sf_dir):
    return dataset_counts(exported(spark, sf_dir))


@query(
    "summarize_subset",
    f"""
    WITH {RELEASE_SQL},
    sizes AS (
      SELECT dataset_type, count(DISTINCT file) AS files, CAST(sum(file_size) AS BIGINT) AS bytes
      FROM release_records WHERE dataset_type IN ('order_f', 'order_p') GROUP BY 1)
    SELECT dataset_type, count(*) AS datasets, any_value(files) AS files, any_value(bytes) AS bytes
    FROM found JOIN sizes USING (dataset_type) GROUP BY 1
    """,
)
def summarize_subset(spark, sf_dir):
    """Summary of the types two globs select, recorded sizes only."""
    summary = summarize(exported(spark, sf_dir), ["*_[fp]", "order_p"])
    return summary.select("dataset_type", "datasets", "files", F.col("bytes").cast("long").alias("bytes"))


@query(
    "transfer_plan",
    f"""
    WITH {RELEASE_SQL},
    files AS (SELECT DISTINCT file, l_partkey FROM release_records),
    planned AS (
    SELECT CASE WHEN starts_with(file, 'file://') THEN substr(file, 8) ELSE file END AS source,
           CASE WHEN starts_with(file, 'file:///archive') THEN 'archive' WHEN starts_with(file, 'file:///data/a') THEN 'a'
                WHEN starts_with(file, 's3://') THEN 'remote' ELSE 'rest' END || '/' ||
           CASE WHEN starts_with(file, 's3://') THEN 'bucket-r/' WHEN starts_with(file, 'file:///data/n') THEN 'data/n/'
                ELSE '' END || 'parts/' || l_partkey || '.zip' AS destination
    FROM files WHERE NOT (starts_with(file, 's3://') AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')))
    SELECT *, CAST(floor((row_number() OVER (ORDER BY source) - 1) / 100) AS BIGINT) AS batch FROM planned
    """,
)
def transfer_plan_query(spark, sf_dir):
    """Files to send; promotional parts of one store are at the destination already."""
    mapping = {"file:///archive": "archive", "file:///data/a": "a", "s3://": "remote", "file:///": "rest"}
    promo = adapters.table(spark, sf_dir, "part").where("p_type = 'PROMO'")
    listing = promo.select(
        F.concat(F.lit("remote/bucket-r/parts/"), F.col("p_partkey"), F.lit(".zip")).alias("destination")
    )
    return transfer_plan(exported(spark, sf_dir), mapping, ["order_*"], listing).select("source", "destination", "batch")


@query(
    "reference_report",
    """
    SELECT 'exposure' AS parent, CAST(0 AS BIGINT) AS orphans
    UNION ALL SELECT 'visit', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    """,
)
def reference_report_query(spark, sf_dir):
    """Definition rows of the release without an exposure or a visit record."""
    report = reference_report(exported(spark, sf_dir), "visit_definition")
    return report.select("parent", "orphans")


@query(
    "pruned_release",
    f"""
    WITH {RELEASE_SQL},
    kept_visits AS (
      SELECT visit FROM found UNION SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT exposure FROM raw_datasets)),
    kept_exposures AS (
      SELECT exposure FROM raw_datasets UNION SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT visit FROM found))
    SELECT 'instrument' AS name, CAST(1 AS BIGINT) AS n_rows
    UNION ALL SELECT 'visit', count(*) FROM customer WHERE c_custkey IN (SELECT visit FROM kept_visits)
    UNION ALL SELECT 'exposure', count(*) FROM orders WHERE o_orderkey IN (SELECT exposure FROM kept_exposures)
    UNION ALL SELECT 'visit_definition', count(*) FROM orders
      WHERE o_orderkey IN (SELECT exposure FROM kept_exposures) OR o_custkey IN (SELECT visit FROM kept_visits)
    UNION ALL SELECT 'visit_system_membership', count(*) FROM customer WHERE c_custkey IN (SELECT visit FROM kept_visits)
    UNION ALL SELECT 'visit_detector_region', count(*) FROM customer WHERE c_custkey IN (SELECT visit FROM kept_visits)
    UNION ALL SELECT 'skymap', count(*) FROM region WHERE r_name <> 'ASIA'
    UNION ALL SELECT 'tract', count(*) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'
    UNION ALL SELECT 'sky_map datasets', count(*) FROM region WHERE r_name <> 'ASIA'
    """,
)
def pruned_release(spark, sf_dir):
    """A release changed in place: one sky map removed, unreferenced records pruned."""
    release = write_release(spark, sf_dir)
    release = change_storage_class(release, ["order_f"], "OtherTable")
    remove_value_from_release(release, {"skymap": "name", "tract": "skymap"}, ["sky_map"], "skymap", "ASIA")
    prune_release(release)
    counts = dimension_counts(release)
    maps = count_report({"sky_map datasets": release.read_datasets("sky_map")})
    return counts.unionByName(maps)


@query(
    "loaded_release",
    f"""
    WITH {RELEASE_SQL}
    SELECT 'dataset_types' AS name, CAST(6 AS BIGINT) AS n_rows UNION ALL SELECT 'datasets', count(*) FROM released
    UNION ALL SELECT 'datastore', count(*) FROM release_records
    UNION ALL SELECT 'tags', count(*) FROM found WHERE tag = 'tags/1'
    UNION ALL SELECT 'calibrations', count(*) FROM found WHERE dataset_type = 'order_p'
    UNION ALL SELECT 'collection_chain', 12
    UNION ALL SELECT 'dimensions/visit', count(*) FROM customer
    UNION ALL SELECT 'dimensions/exposure', count(*) FROM orders
    """,
)
def loaded_release(spark, sf_dir):
    """The release loaded into tables, file paths mapped to datastores on the way."""
    mapping = {"file:///archive": "archive", "file:///data": "data", "s3://bucket-r": "remote"}
    paths = load_release(
        exported(spark, sf_dir),
        staging_path(spark, "loaded"),
        datastore_transform=lambda records: map_to_datastores(records, mapping),
        alias=("nested", "short"),
    )
    names = (
        "dataset_types datasets datastore tags calibrations collection_chain dimensions/visit dimensions/exposure"
    ).split()
    return count_report({name: spark.read.parquet(paths[name]) for name in names})


@query(
    "loaded_records",
    f"""
    WITH {RELEASE_SQL}
    SELECT dataset_type, dataset_id,
           CASE WHEN starts_with(file, 'file:///archive/') THEN 'archive'
                WHEN starts_with(file, 's3://') THEN 'remote' ELSE 'data' END AS datastore_name,
           CASE WHEN starts_with(file, 'file:///data/a/') THEN 'a/' WHEN starts_with(file, 'file:///data/n/') THEN 'n/'
                ELSE '' END || 'parts/' || l_partkey || '.zip' AS path
    FROM release_records
    """,
)
def loaded_records(spark, sf_dir):
    """File records as a load leaves them: the datastore and the path in it."""
    mapping = {"file:///archive": "archive", "file:///data": "data", "s3://bucket-r": "remote"}
    paths = load_release(
        exported(spark, sf_dir),
        staging_path(spark, "records"),
        datastore_transform=lambda records: map_to_datastores(records, mapping),
    )
    loaded = spark.read.parquet(paths["datastore"])
    return loaded.select(
        "dataset_type",
        binary_to_hex("dataset_id").alias("dataset_id"),
        "datastore_name",
        F.substring_index("path", "#", 1).alias("path"),
    )


def damaged(spark, sf_dir) -> Release:
    """A release without the visits of one market segment, the exposures of one priority, one sky map, and the flux
    datasets of one run, whose records and associations are left behind."""
    release = write_release(spark, sf_dir)
    building = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    changes = {
        "visit": lambda df: keep_missing(df, building, {"id": "c_custkey"}),
        "exposure": lambda df: df.where("obs_id NOT LIKE '1%'"),
        "skymap": lambda df: df.where("name != 'ASIA'"),
    }
    rewrites = {release.dimension_path(n): (change, release.spec.record_schema(n)) for n, change in changes.items()}
    kind = release.type_named("order_f")
    datasets = release.spec.dataset_schema(kind["dimensions"])
    rewrites[release.path_of(kind["dataset_export_file"])] = (lambda df: df.where("run != 'runs/1999'"), datasets)
    rewrite_tables(spark, rewrites)
    return release


@query(
    "dataset_orphans",
    f"""
    WITH {RELEASE_SQL},
    kept AS (SELECT * FROM released WHERE NOT (dataset_type = 'order_f' AND run = 'runs/1999'))
    SELECT dataset_type, 'visit' AS dimension, count(DISTINCT visit) AS orphans
    FROM kept WHERE visit NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1
    UNION ALL SELECT dataset_type, 'exposure', count(*)
    FROM kept WHERE exposure IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%') GROUP BY 1
    UNION ALL SELECT dataset_type, 'skymap', count(*) FROM kept WHERE skymap = 'ASIA' GROUP BY 1
    """,
)
def dataset_orphans_query(spark, sf_dir):
    """Data IDs of a damaged release whose visit, exposure or sky map has no record."""
    return dataset_orphans(damaged(spark, sf_dir))


@query(
    "record_orphans",
    """
    WITH visits AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
    found AS (
      SELECT 'visit_definition' AS dimension, 'visit' AS parent FROM orders WHERE o_custkey NOT IN (SELECT * FROM visits)
      UNION ALL SELECT 'visit_definition', 'exposure' FROM orders WHERE o_orderpriority LIKE '1%'
      UNION ALL SELECT unnest(['visit_system_membership', 'visit_detector_region']), 'visit'
        FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL SELECT 'tract', 'skymap' FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
    SELECT dimension, parent, count(*) AS orphans FROM found GROUP BY 1, 2
    """,
)
def record_orphans_query(spark, sf_dir):
    """Records of a damaged release that refer to a missing record, of all elements in one pass."""
    orphaned = record_orphans(damaged(spark, sf_dir))
    return orphaned.withColumn("orphans", F.col("orphans").cast("long"))


@query(
    "stray_rows",
    f"""
    WITH {RELEASE_SQL},
    gone AS (SELECT * FROM found WHERE dataset_type = 'order_f' AND run = 'runs/1999')
    SELECT 'datastore' AS kind, dataset_type, count(*) AS orphans FROM gone JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 2
    UNION ALL SELECT 'association', dataset_type, count(*) FROM gone WHERE tag = 'tags/1' GROUP BY 2
    """,
)
def stray_rows_query(spark, sf_dir):
    """File records and associations of a damaged release without a dataset."""
    return stray_rows(damaged(spark, sf_dir))
