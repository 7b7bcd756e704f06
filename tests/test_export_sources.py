"""How often an export evaluates the catalog's tables, and how it writes and reads many rows of few types."""

import pytest
from pyspark.sql import functions as F

from releasecat.operators.selection import union_by_name
from releasecat.plans.export import export_release
from releasecat.schemas import DATASTORE, STANDARD_SPEC, TIMESPAN, as_nullable
from releasecat.session import WRITERS, configure, side_by_side, staging_path
from releasecat.sinks.tables import write_by_type
from releasecat.sources.catalog import Catalog
from releasecat.sources.release import Release

TYPES = "name string, storageClass string, dimensions array<string>, parentStorageClass string, isCalibration boolean"
RECORD = ("d", None, "p", "f", "s", None, None, 1)


def key(number):
    return number.to_bytes(16, "big")


def counted(spark, df, column):
    """The table, and how many of its rows have been evaluated."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(value):
        seen.add(1)
        return value

    return df.withColumn(column, look.asNondeterministic()(F.col(column))), seen


def test_an_export_evaluates_each_table_of_the_catalog_once(spark):
    configure(spark)
    datasets = [(key(n), ("one", "many", "note")[n % 3], f"run{n % 2}", "cam", n if n % 3 < 2 else None) for n in range(60)]
    members = [(key(n), ("pick", "bias")[n % 2], None) for n in range(0, 60, 2)] + [(key(n), "bias", (n, n + 1)) for n in range(1, 60, 3)]
    runs = [(f"run{n}", 1, "", []) for n in (0, 1)]
    kinds = [("pick", 2, "", []), ("bias", 4, "", []), ("top", 3, "", ["run0", "pick", "bias"])]
    tables = {
        "datasets": (spark.createDataFrame(datasets, "dataset_id binary, dataset_type string, run string, instrument string, exposure long"), "run"),
        "collections": (spark.createDataFrame([*runs, *kinds], "name string, type byte, doc string, children array<string>"), "doc"),
        "memberships": (spark.createDataFrame(members, f"dataset_id binary, collection string, timespan {TIMESPAN.simpleString()}"), "collection"),
    }
    sizes = {name: df.count() for name, (df, _) in tables.items()}
    watched = {name: counted(spark, df, column) for name, (df, column) in tables.items()}
    catalog = Catalog(
        dataset_types=spark.createDataFrame(
            [("one", "A", ["instrument", "exposure"], None, False), ("many", "A", ["instrument", "exposure"], None, True), ("note", "A", [], None, False)], TYPES
        ),
        datastore=spark.createDataFrame([("d", key(n), f"file:///x/{n}", "f", "s", None, None, n) for n in range(60)], DATASTORE),
        dimensions={"instrument": spark.createDataFrame([("cam", 1, 2, 3, 4, "c")], STANDARD_SPEC.record_schema("instrument"))},
        roots={},
        **{name: df for name, (df, _) in watched.items()},
    )
    release = export_release(catalog, staging_path(spark, "once"), ["one", "many"], ["note"], ["top"])
    assert {name: seen.value for name, (_, seen) in watched.items()} == sizes

    in_calib = {m[0] for m in members}
    reached = {d[0]: d[1] for d in datasets if d[2] == "run0" or d[0] in in_calib}
    # Data IDs differ, so find-first keeps all; provenance is taken from every run that was found.
    expected = {d[0]: d[1] for d in datasets if d[1] != "note" and d[0] in reached or d[1] == "note"}
    assert {bytes(r["dataset_id"]): r["dataset_type"] for r in release.read_all_datasets().collect()} == expected
    records = release.read_all_datastore().collect()
    assert {bytes(r["dataset_id"]): r["dataset_type"] for r in records} == expected and len(records) == len(expected)
    entries = release.read_all_associations().collect()
    assert sorted((bytes(r["dataset_id"]), r["collection"]) for r in entries) == sorted((m[0], m[1]) for m in members if m[0] in expected)


@pytest.mark.parametrize("names", [["a b", "c%20d", "e+f", "é#x"], ["plain", "other"]])
def test_the_type_of_a_row_is_found_once_for_a_file(spark, names):
    """Tables that are folders of part files, and one that is a single file."""
    schema = as_nullable(DATASTORE)
    directory = staging_path(spark, "typed")
    for n, name in enumerate(names):
        rows = spark.createDataFrame([(*RECORD[:1], key(n), *RECORD[2:])] * (n + 1), schema)
        rows.repartition(n + 1).write.parquet(f"{directory}/{name}")
    folder, last = f"{directory}/{names[-1]}", names[-1]
    one = [f.split("/")[-1] for f in spark.read.schema(schema).parquet(f"{directory}/{names[0]}").inputFiles()]
    files = {**{name: [name] for name in names[1:]}, f"{names[0]}/{one[0]}": [names[0]], last: [last, "twin"]}
    scan = Release(spark, directory)._typed_scan(schema, files)
    plan = scan._jdf.queryExecution().optimizedPlan().toString()
    assert "url_decode" not in plan.lower() and "regexp_replace" not in plan
    counts = {r["dataset_type"]: r["count"] for r in scan.groupBy("dataset_type").count().collect()}
    assert counts == {**{name: n + 1 for n, name in enumerate(names)}, "twin": len(names)}, folder


def test_rows_of_few_types_are_written_without_a_shuffle_or_sort(spark):
    configure(spark)
    schema = as_nullable(DATASTORE)
    typed = [spark.createDataFrame([(*RECORD[:1], key(n), *RECORD[2:])], schema).withColumn("dataset_type", F.lit(f"t{n % 3}")) for n in range(12)]
    rows = union_by_name(typed).coalesce(2)
    base = staging_path(spark, "few")
    spark.range(1).write.parquet(base)
    before = spark.conf.get(WRITERS)
    with side_by_side(spark, 4):
        assert spark.conf.get(WRITERS) == "5"
        write_by_type(rows, schema, {f"t{n}": f"{base}/t{n}" for n in range(4)}, spread=False)
    assert spark.conf.get(WRITERS) == before
    with side_by_side(spark, 9):
        assert spark.conf.get(WRITERS) == before
    for n in range(4):
        read = spark.read.schema(schema).parquet(f"{base}/t{n}")
        assert sorted(bytes(r["dataset_id"])[-1] for r in read.collect()) == (list(range(n, 12, 3)) if n < 3 else [])
        # Each of the two tasks writes a file of each of its types.
        assert n == 3 or len(read.inputFiles()) == 2
