"""What Spark plans: pushed filters, pruned columns, early limits and split hot keys."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from releasecat.operators.joins import keep_matching, keep_matching_any
from releasecat.operators.paths import make_paths_absolute, map_to_datastores
from releasecat.operators.search import find_first
from releasecat.operators.summary import files_without_size, release_summary
from releasecat.plans.load import dataset_orphans, record_orphans, reference_report, stray_rows
from releasecat.registry import adapters, dump_queries
from releasecat.registry.base import table
from releasecat.schemas import DATASTORE, as_nullable
from releasecat.session import configure, staging_path
from releasecat.sinks.tables import write_by_type, write_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL_SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
}


def hot_table(spark):
    """One key holds half of the rows."""
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(0, 200_000, 1, 8).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("x"))


def test_a_hot_key_is_split_in_a_semi_join(spark):
    configure(spark)
    with settings(spark, **SMALL_SKEW):
        df = keep_matching(hot_table(spark), spark.range(0, 4000, 1, 4).selectExpr("id AS k"), "k")
        rows = df.collect()
        assert "skew=true" in plan_of(df)
    assert len(rows) == 100_000 + sum(1 for i in range(1, 200_000, 2) if i % 5000 < 4000)


def test_a_hot_key_is_split_where_either_key_counts(spark):
    with settings(spark, **SMALL_SKEW):
        a = spark.range(0, 4000, 1, 4).selectExpr("id AS k")
        b = spark.range(0, 10, 1, 1).selectExpr("id AS v")
        df = keep_matching_any(hot_table(spark), (a, "k"), (b, "v"))
        count = len(df.select("v").collect())
        plan = plan_of(df)
        assert count > 100_000
        df.write.format("noop").mode("overwrite").save()
    assert "ExistenceJoin" not in plan and "Cartesian" not in plan


def test_find_first_limits_before_the_shuffle(spark):
    df = hot_table(spark).withColumn("search_rank", F.col("v") % 3).withColumn("dataset_id", F.col("v"))
    best = find_first(df, ["k"])
    plan = plan_of(best)
    assert len(re.findall("WindowGroupLimit", plan)) == 2 and "Partial" in plan
    assert best.count() == df.select("k").distinct().count()


@pytest.fixture(scope="module")
def records_path(spark, sf_dir):
    path = staging_path(spark, "records")
    write_table(adapters.datastore(spark, sf_dir), path, DATASTORE)
    return path


def test_unknown_sizes_are_filtered_in_the_scan(spark, records_path):
    records = spark.read.schema(as_nullable(DATASTORE)).parquet(records_path)
    plan = plan_of(files_without_size(records))
    assert "PushedFilters: [IsNull(file_size)]" in plan
    assert "ReadSchema: struct<path:string,file_size:bigint>" in plan


def test_the_summary_groups_before_it_shuffles(spark, records_path):
    records = spark.read.schema(as_nullable(DATASTORE)).parquet(records_path).withColumn("dataset_type", F.lit("t"))
    plan = plan_of(release_summary(records.select("dataset_type"), records))
    assert "partial_sum(file_size" in plan
    assert "formatter" not in plan and "dataset_id" not in plan


def test_path_rules_stay_in_generated_code(spark, records_path):
    records = spark.read.schema(as_nullable(DATASTORE)).parquet(records_path)
    mapped = map_to_datastores(make_paths_absolute(records, adapters.ROOTS), {"file:///": "a", "s3://": "b"})
    plan = plan_of(mapped)
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
    mapped.write.format("noop").mode("overwrite").save()


def test_a_dump_scan_reads_only_what_is_needed(spark, sf_dir):
    release = dump_queries.exported(spark, sf_dir)
    ids = release.read_datasets("order_f").where("visit = 3").select("dataset_id")
    plan = plan_of(ids)
    assert "ReadSchema: struct<dataset_id:binary,visit:bigint>" in plan
    assert "EqualTo(visit,3)" in plan


def test_one_large_type_is_written_in_several_files(spark, sf_dir):
    schema = as_nullable(DATASTORE)
    big = adapters.datastore(spark, sf_dir).repartition(8).withColumn("dataset_type", F.when(F.col("file_size") == 1000, "rare").otherwise("large"))
    base = staging_path(spark, "typed")
    spark.range(1).write.parquet(base)
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB"):
        write_by_type(big, schema, {n: f"{base}/{n}" for n in ("large", "rare", "none")}, ())
    read = {n: spark.read.schema(schema).parquet(f"{base}/{n}") for n in ("large", "rare", "none")}
    assert read["none"].count() == 0
    assert read["large"].count() + read["rare"].count() == table(spark, sf_dir, "lineitem").count()
    assert len(read["large"].inputFiles()) > 1


def test_sorted_writes_keep_the_order_across_files(spark, sf_dir):
    entries = adapters.memberships(spark, sf_dir).withColumn("dataset_type", F.lit("t"))
    base = staging_path(spark, "sorted")
    spark.range(1).write.parquet(base)
    schema = as_nullable(entries.drop("dataset_type").schema)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        write_by_type(entries, schema, {"t": f"{base}/t"}, ("collection", "dataset_id"))
    files = sorted(spark.read.parquet(f"{base}/t").inputFiles())
    assert len(files) > 1
    names = [r["collection"] for f in files for r in spark.read.parquet(f).select("collection").collect()]
    assert names == sorted(names)


def test_sides_that_grow_with_a_release_are_not_planned_as_broadcasts(spark, sf_dir):
    release = dump_queries.exported(spark, sf_dir)
    reports = {
        "reference_report": reference_report(release, "visit_definition"),
        "dataset_orphans": dataset_orphans(release),
        "record_orphans": record_orphans(release),
        "stray_rows": stray_rows(release),
    }
    for name, report in reports.items():
        # The plan before it runs: what is broadcast there stays so, whatever size is measured.
        joins = [line for line in plan_of(report).splitlines() if "LeftAnti" in line]
        assert joins and not any("BroadcastHashJoin" in line for line in joins), name


def test_numbers_lead_the_sort_of_find_first(spark, sf_dir):
    plan = plan_of(find_first(adapters.datasets(spark, sf_dir).withColumn("search_rank", F.lit(1)), ["dataset_type", "instrument", "visit"]))
    assert "Sort [visit" in plan
