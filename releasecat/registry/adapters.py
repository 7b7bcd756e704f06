"""The driver's tables in the shape of a catalog.

Orders are datasets, customers are visits, orders are also exposures, line
items are file records and tagged or calibration entries follow from an
order's priority and status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.collections import flatten_collections
from ..schemas import CALIBRATION, CHAINED, RUN, STANDARD_SPEC, TAGGED, conform, empty_columns
from ..sources.catalog import Catalog
from .base import table

ROOTS = {"store_a": "file:///data/a", "store_n": "file:///data/n/", "store_r": "s3://bucket-r"}
CHAINS = {
    "release": ["runs/2001", "runs/2000", "runs/1999", "nested"],
    "nested": ["tags/1", "calibs/p", "runs/raw", "runs/1998"],
}
DAY_NSEC = 86_400_000_000_000


def dataset_key(prefix: str, number) -> F.Column:
    """16-byte id: a hex digit for the kind of dataset, then the number."""
    # The digit and the zeros after it are one constant: only the number's 16 digits are made for each row.
    return F.concat(F.unhex(F.lit(prefix + "0" * 15)), F.unhex(F.lpad(F.hex(number.cast("long")), 16, "0")))


def order_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        dataset_key("0", F.col("o_orderkey")).alias("dataset_id"),
        F.concat(F.lit("order_"), F.lower("o_orderstatus")).alias("dataset_type"),
        order_run().alias("run"),
        F.lit("cam").alias("instrument"),
        F.col("o_custkey").alias("visit"),
        F.lit(None).cast("long").alias("exposure"),
        F.lit(None).cast("string").alias("skymap"),
    )


def order_run() -> F.Column:
    return F.concat(F.lit("runs/"), F.year("o_orderdate").cast("string"))


def raw_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_linestatus = 'F'")
    return items.select("l_orderkey").distinct().select(
        dataset_key("a", F.col("l_orderkey")).alias("dataset_id"),
        F.lit("raw").alias("dataset_type"),
        F.lit("runs/raw").alias("run"),
        F.lit("cam").alias("instrument"),
        F.lit(None).cast("long").alias("visit"),
        F.col("l_orderkey").alias("exposure"),
        F.lit(None).cast("string").alias("skymap"),
    )


def provenance_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), order_run().alias("run"))
    return years.distinct().select(
        dataset_key("c", F.col("year")).alias("dataset_id"),
        F.lit("run_provenance").alias("dataset_type"),
        "run",
        *[F.lit(None).cast(t).alias(c) for c, t in _DATA_ID],
    )


def skymap_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        dataset_key("d", F.col("r_regionkey")).alias("dataset_id"),
        F.lit("sky_map").alias("dataset_type"),
        F.lit("runs/2001").alias("run"),
        *[F.lit(None).cast(t).alias(c) for c, t in _DATA_ID[:-1]],
        F.col("r_name").alias("skymap"),
    )


_DATA_ID = (("instrument", "string"), ("visit", "long"), ("exposure", "long"), ("skymap", "string"))


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = (order_datasets, raw_datasets, provenance_datasets, skymap_datasets)
    first, *others = [part(spark, sf_dir) for part in parts]
    for other in others:
        first = first.unionByName(other)
    return first


def dataset_types(spark: SparkSession) -> DataFrame:
    rows = [
        ("order_f", "Table", ["instrument", "visit"], None, False),
        ("order_o", "Table", ["instrument", "visit"], None, False),
        ("order_p", "Table", ["instrument", "visit"], None, True),
        ("raw", "Image", ["instrument", "exposure"], None, False),
        ("run_provenance", "Text", [], None, False),
        ("sky_map", "Map", ["skymap"], None, False),
    ]
    return spark.createDataFrame(
        rows,
        "name string, storageClass string, dimensions array<string>, parentStorageClass string, "
        "isCalibration boolean",
    )


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and tags that occur in the orders, one calibration collection and two chains."""
    orders = table(spark, sf_dir, "orders")
    found = [
        (orders.select(order_run().alias("name")).distinct(), RUN),
        (orders.select(_tag().alias("name")).distinct(), TAGGED),
        (orders.where("o_orderstatus = 'P'").select(_calibration().alias("name")).distinct(), CALIBRATION),
        (raw_datasets(spark, sf_dir).select(F.col("run").alias("name")).distinct(), RUN),
    ]
    table_ = spark.createDataFrame(
        [(name, CHAINED, "a chain", children) for name, children in CHAINS.items()],
        "name string, type byte, doc string, children array<string>",
    )
    for names, kind in found:
        table_ = table_.unionByName(
            names.select(
                "name",
                F.lit(kind).cast("byte").alias("type"),
                F.lit("").alias("doc"),
                F.array().cast("array<string>").alias("children"),
            )
        )
    return table_


def ranked_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_collections(collections(spark, sf_dir), ["release"])


def _tag() -> F.Column:
    return F.concat(F.lit("tags/"), F.substring("o_orderpriority", 1, 1))


def _calibration() -> F.Column:
    # Made from the status: a literal would turn the joins on it into comparisons with a constant.
    return F.concat(F.lit("calibs/"), F.lower("o_orderstatus"))


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is tagged by its priority; orders of status P are valid on their day."""
    orders = table(spark, sf_dir, "orders")
    identity = dataset_key("0", F.col("o_orderkey")).alias("dataset_id")
    begin = F.unix_date(F.to_date("o_orderdate")).cast("long") * F.lit(DAY_NSEC)
    span = "struct<begin_nsec:bigint,end_nsec:bigint>"
    tagged = orders.select(identity, _tag().alias("collection"), F.lit(None).cast(span).alias("timespan"))
    valid = orders.where("o_orderstatus = 'P'").select(
        identity,
        _calibration().alias("collection"),
        F.struct(begin.alias("begin_nsec"), (begin + F.lit(DAY_NSEC)).alias("end_nsec")).cast(span).alias("timespan"),
    )
    return tagged.unionByName(valid)


def datastore(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """A file record for each line item: a member of its part's archive.

    Returned items have no recorded size and open ones an absolute path.
    """
    member = F.concat(
        F.lit("parts/"), F.col("l_partkey"), F.lit(".zip#unzip="), F.col("l_orderkey")
    )
    return table(spark, sf_dir, "lineitem").select(
        *keys,
        F.concat(F.lit("store_"), F.lower("l_returnflag")).alias("datastore_name"),
        dataset_key("0", F.col("l_orderkey")).alias("dataset_id"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("file:///archive/"), member)).otherwise(member).alias("path"),
        F.lit("row").alias("formatter"),
        F.lit("Table").alias("storage_class"),
        F.lit(None).cast("string").alias("component"),
        F.lit(None).cast("string").alias("checksum"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("long") * 1000).alias("file_size"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    cam = F.lit("cam").alias("instrument")
    records = {
        "instrument": orders.select(F.lit("cam").alias("name")).distinct(),
        "visit": customer.select(cam, F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "exposure": orders.select(cam, F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("obs_id")),
        "visit_definition": orders.select(cam, F.col("o_orderkey").alias("exposure"), F.col("o_custkey").alias("visit")),
        "visit_system_membership": customer.select(
            cam, F.col("c_custkey").alias("visit"), F.col("c_nationkey").cast("long").alias("visit_system")
        ),
        "visit_detector_region": customer.select(
            cam,
            F.col("c_custkey").alias("visit"),
            F.col("c_nationkey").cast("long").alias("detector"),
            F.col("c_name").cast("binary").alias("region"),
        ),
        "skymap": region.select(F.col("r_name").alias("name")),
        "tract": nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("r_name").alias("skymap"), F.col("n_nationkey").cast("long").alias("id")
        ),
    }
    return {name: _as_records(df, name) for name, df in records.items()}


def _as_records(df: DataFrame, name: str) -> DataFrame:
    schema = STANDARD_SPEC.record_schema(name)
    return conform(empty_columns(df, {f.name: f.dataType for f in schema.fields}), schema)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(
        dataset_types=dataset_types(spark),
        datasets=datasets(spark, sf_dir),
        collections=collections(spark, sf_dir),
        memberships=memberships(spark, sf_dir),
        datastore=datastore(spark, sf_dir),
        dimensions=dimensions(spark, sf_dir),
        roots=ROOTS,
    )


# The same tables in SQL, for the queries' reference results.

DATASETS_SQL = """
order_datasets AS (
  SELECT '0' || lpad(lower(hex(o_orderkey)), 31, '0') AS dataset_id,
         'order_' || lower(o_orderstatus) AS dataset_type,
         'runs/' || CAST(year(o_orderdate) AS VARCHAR) AS run,
         'cam' AS instrument, o_custkey AS visit, o_orderkey, o_orderdate,
         'tags/' || substr(o_orderpriority, 1, 1) AS tag
  FROM orders),
raw_datasets AS (
  SELECT DISTINCT 'a' || lpad(lower(hex(l_orderkey)), 31, '0') AS dataset_id, 'runs/raw' AS run,
         'cam' AS instrument, l_orderkey AS exposure
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
"""

RANKS_SQL = """
ranks(name, type, search_rank) AS (
  VALUES ('release', 3, 0), ('runs/2001', 1, 1), ('runs/2000', 1, 2), ('runs/1999', 1, 3), ('nested', 3, 4),
         ('tags/1', 2, 5), ('calibs/p', 4, 6), ('runs/raw', 1, 7), ('runs/1998', 1, 8))
"""

CANDIDATES_SQL = f"""
{DATASETS_SQL}, {RANKS_SQL},
memberships AS (
  SELECT o_orderkey, tag AS collection FROM order_datasets
  UNION ALL SELECT o_orderkey, 'calibs/p' FROM order_datasets WHERE dataset_type = 'order_p'),
candidates AS (
  SELECT d.*, r.name AS collection, r.search_rank
  FROM order_datasets d JOIN ranks r ON d.run = r.name AND r.type = 1
  UNION ALL
  SELECT d.*, r.name, r.search_rank
  FROM order_datasets d JOIN memberships m ON d.o_orderkey = m.o_orderkey
  JOIN ranks r ON m.collection = r.name AND r.type IN (2, 4)),
found AS (
  SELECT dataset_id, dataset_type, run, instrument, visit, o_orderkey, o_orderdate, tag FROM (
    SELECT *, row_number() OVER (
      PARTITION BY dataset_type, instrument, visit ORDER BY search_rank, dataset_id) AS place
    FROM candidates WHERE dataset_type <> 'order_p')
  WHERE place = 1
  UNION ALL
  SELECT DISTINCT dataset_id, dataset_type, run, instrument, visit, o_orderkey, o_orderdate, tag
  FROM candidates WHERE dataset_type = 'order_p')
"""
