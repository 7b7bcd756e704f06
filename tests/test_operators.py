"""Joins, orders, transfers, progress and summaries on small tables with known results."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from releasecat import fs
from releasecat.operators.joins import (
    fill_sizes,
    keep_matching,
    keep_matching_any,
    keep_missing,
    orphans,
)
from releasecat.operators.ordering import row_index, running_total
from releasecat.operators.progress import fold_progress, overall_progress
from releasecat.operators.search import find_first, search, search_all
from releasecat.operators.summary import collection_units, count_files, known_size, listed_size, release_summary
from releasecat.operators.transfer import (
    assign_batches,
    run_transfers,
    running_transfer_totals,
    transfer_totals,
)
from releasecat.operators.validation import duplicate_ids, missing_types
from releasecat.schemas import PROGRESS_EVENTS, STANDARD_SPEC
from releasecat.session import staging_path
from releasecat.streaming import progress as progress_stream
from releasecat.streaming.progress import read_events, read_progress, write_progress


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_keys_with_nulls_and_repeats(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert rows_of(keep_matching(left, right, {"k": "key"})) == [(1, "a"), (1, "a")]
    assert rows_of(keep_missing(left, right, {"k": "key"})) == [(2, "b"), (None, "c")]
    assert rows_of(orphans(left, right, {"k": "key"})) == [(2, "b")]
    same = keep_matching(left, left.where("v = 'b'"), "k")
    assert rows_of(same) == [(2, "b")]


def test_either_key_is_enough(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (1, 10), (None, 20), (None, None)], "a int, b int")
    a = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    b = spark.createDataFrame([(20,), (None,)], "b int")
    assert rows_of(keep_matching_any(left, (a, "a"), (b, "b"))) == [(1, 10), (2, 20), (None, 20)]


def test_running_total_equals_a_window_even_with_one_hot_value(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 37) % 101).alias("t"), "id", (F.col("id") % 11).alias("n")
    )
    total = {r["id"]: r["total"] for r in running_total(df, ["t", "id"], "n", "total", slices=7).collect()}
    expected, amount = {}, 0
    for row in sorted(df.collect(), key=lambda r: (r["t"], r["id"])):
        amount += row["n"]
        expected[row["id"]] = amount
    assert total == expected


def test_row_index_is_dense_with_nulls_last(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "x int")
    assert rows_of(row_index(df, ["x"], "i", slices=3)) == [(1, 0), (2, 1), (3, 2), (None, 3)]
    assert row_index(df.where("false"), ["x"], "i").count() == 0


def test_running_total_uses_no_single_partition_window_on_rows(spark):
    df = spark.range(1000).withColumn("n", F.lit(1))
    parts = running_total(df, ["id"], "n", "t", slices=8).select(F.spark_partition_id().alias("p")).distinct()
    assert parts.count() > 1


def test_batches_are_full_but_the_last(spark):
    for count, size in ((1003, 10), (1000, 1000), (1001, 1000), (7, 9)):
        files = spark.range(count).select(F.concat(F.lit("f"), "id").alias("source"))
        batched = assign_batches(files, size)
        assert batched.columns == ["source", "batch"] and batched.select("source").distinct().count() == count
        full, rest = divmod(count, size)
        expected = [(n, size) for n in range(full)] + ([(full, rest)] if rest else [])
        assert sorted(rows_of(batched.groupBy("batch").count())) == expected
        ends = batched.groupBy("batch").agg(F.min("source"), F.max("source")).orderBy("batch").collect()
        assert all(a[2] < b[1] for a, b in zip(ends, ends[1:]))


def test_transfers_copy_once_and_skip_later(spark, tmp_path):
    source, target = tmp_path / "source", tmp_path / "target"
    source.mkdir()
    names = [f"f{n}" for n in range(25)]
    for name in names:
        (source / name).write_text(name)
    pairs = spark.createDataFrame([(f"{source}/{n}", f"{target}/x/{n}") for n in names], "source string, destination string")
    batches = assign_batches(pairs, 4)

    def copy(origin, destination):
        if Path(destination).exists():
            return False
        Path(destination).parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(origin, destination)
        return True

    results = run_transfers(batches, copy)
    first = transfer_totals(results).first()
    assert (first["uploaded"], first["skipped"], first["total"]) == (25, 0, 25)
    assert (target / "x" / "f7").read_text() == "f7"
    again = transfer_totals(run_transfers(batches, copy)).first()
    assert (again["uploaded"], again["skipped"]) == (0, 25)
    assert transfer_totals(results.where("false")).first()["total"] == 0


def test_running_transfer_totals(spark):
    results = spark.createDataFrame([(1, 5, 0), (2, 0, 3), (3, 1, 1)], "seq int, uploaded long, skipped long")
    assert rows_of(running_transfer_totals(results, ["seq"]), "seq", "total") == [(1, 5), (2, 8), (3, 10)]


EVENTS = [
    ("started", "a", 10, None),
    ("progress", "a", None, 4),
    ("progress", "a", None, 6),
    ("completed", "a", None, None),
    ("started", "b", 3, None),
    ("progress", "b", None, 2),
    ("started", "empty", 0, None),
    ("completed", "empty", None, None),
]


def test_progress_of_batch_and_stream_agree(spark):
    events = spark.createDataFrame(EVENTS, PROGRESS_EVENTS)
    expected = [("a", 10, 10, "complete"), ("b", 3, 2, "working"), ("empty", 0, 0, "complete")]
    assert rows_of(fold_progress(events)) == expected
    assert tuple(overall_progress(fold_progress(events)).first()) == (2, 3, 12)
    source, target, place = (staging_path(spark, n) for n in ("events", "folded", "place"))
    events.limit(5).coalesce(1).write.parquet(source)
    write_progress(read_events(spark, source, 1), target, place).awaitTermination()
    assert rows_of(read_progress(spark, target))[0] == ("a", 10, 10, "complete")
    before = set(spark.read.parquet(f"{target}/dataset_type=a").inputFiles())
    # More events arrive; the stream goes on where it stopped.
    spark.createDataFrame(EVENTS[5:], PROGRESS_EVENTS).repartition(2).write.mode("append").parquet(source)
    write_progress(read_events(spark, source, 1), target, place).awaitTermination()
    assert rows_of(read_progress(spark, target)) == expected
    # What has not changed is not written again.
    assert set(spark.read.parquet(f"{target}/dataset_type=a").inputFiles()) == before
    more = [("started", "007", 4, None), ("progress", "007", None, 1), ("progress", "b", None, 1)]
    spark.createDataFrame(more, PROGRESS_EVENTS).coalesce(1).write.mode("append").parquet(source)
    write_progress(read_events(spark, source, 1), target, place).awaitTermination()
    assert rows_of(read_progress(spark, target)) == [("007", 4, 1, "working"), expected[0], ("b", 3, 3, "working"), expected[2]]


def test_many_types_share_the_files_of_a_trigger(spark, monkeypatch):
    monkeypatch.setattr(progress_stream, "CHANGES", 3)
    source, target, place = (staging_path(spark, n) for n in ("events", "folded", "place"))
    seen = []
    for load in range(8):
        events = [("started", f"t{n}", n, None) for n in range(load * 10)] + [("progress", "007", None, 1), ("progress", None, None, load)]
        spark.createDataFrame(events, PROGRESS_EVENTS).coalesce(1).write.mode("append").parquet(source)
        seen += events
        write_progress(read_events(spark, source, 1), target, place, by_type=False).awaitTermination()
        expected = rows_of(fold_progress(spark.createDataFrame(seen, PROGRESS_EVENTS)).fillna("-", ["dataset_type"]))
        assert rows_of(read_progress(spark, target).fillna("-", ["dataset_type"])) == expected
        # A folder for each trigger since the last three were joined, and none for each type.
        assert len([n for n in fs.list_names(spark, target) if n.startswith("version=")]) <= 4
    # Joining that was cut short before the earlier versions went is repeated without harm.
    progress_stream._join_versions(spark, target, 100)
    progress_stream._join_versions(spark, target, 100)
    assert rows_of(read_progress(spark, target).fillna("-", ["dataset_type"])) == expected


def test_find_first_gives_one_row_for_each_key_with_null_keys(spark):
    df = spark.createDataFrame(
        [("t", 1, None, 2, 5), ("t", 1, None, 1, 9), ("t", 1, None, 1, 8), ("u", 1, None, 3, 1)],
        "kind string, a int, b int, search_rank int, dataset_id int",
    )
    assert rows_of(find_first(df, ["kind", "a", "b"]), "kind", "dataset_id") == [("t", 8), ("u", 1)]


def test_a_dataset_reached_twice_is_found_once(spark):
    span = "struct<begin_nsec:bigint,end_nsec:bigint>"
    datasets = spark.createDataFrame([(1, "r1"), (2, "r2"), (3, "r3")], "dataset_id int, run string")
    members = spark.createDataFrame([(1, "cal", None), (1, "cal", (1, 2)), (2, "cal", None), (3, "no", None)], f"dataset_id int, collection string, timespan {span}")
    places = spark.createDataFrame([("r1", 1, 0), ("cal", 4, 1), ("chain", 3, 2)], "name string, type byte, search_rank int")
    assert rows_of(search_all(datasets, members, places)) == [(1, "r1"), (2, "r2")]
    assert search(datasets, members, places).count() == 4


def test_sizes_by_record_and_by_file(spark):
    records = spark.createDataFrame(
        [("t", "a#1", 5), ("t", "a#2", 5), ("t", "b", None), ("t", "b#x", None), ("t", None, None), ("u", "b", None)],
        "dataset_type string, path string, file_size long",
    )
    listing = spark.createDataFrame([("b", 100), ("b", 100), ("c", 1)], "file string, size long")
    assert rows_of(count_files(records, "dataset_type")) == [("t", 3), ("u", 1)]
    assert [int(r["bytes"]) for r in known_size(records).collect()] == [10]
    assert [int(r["bytes"]) for r in known_size(records.where("false")).collect()] == [0]
    assert {r["dataset_type"]: int(r["bytes"]) for r in listed_size(records, listing, "dataset_type").collect()} == {"t": 100, "u": 100}
    datasets = spark.createDataFrame([("t",), ("t",), ("v",)], "dataset_type string")
    summary = release_summary(datasets, records, listing)
    assert [(r["dataset_type"], r["datasets"], r["files"], int(r["bytes"])) for r in summary.collect()] == [
        ("t", 2, 3, 110),
        ("u", 0, 1, 100),
        ("v", 1, 0, 0),
    ]
    assert rows_of(fill_sizes(spark.createDataFrame([("b",), ("z",)], "file string"), listing)) == [("b", 100), ("z", None)]


def test_very_large_sizes_do_not_overflow(spark):
    records = spark.range(4).select(F.lit("t").alias("dataset_type"), F.col("id").cast("string").alias("path"), F.lit(2**62).alias("file_size"))
    assert int(known_size(records).first()["bytes"]) == 2**64
    summary = release_summary(records.select("dataset_type"), records)
    assert int(summary.first()["bytes"]) == 2**64


def test_units_and_checks(spark):
    span = "struct<begin_nsec:bigint,end_nsec:bigint>"
    entries = spark.createDataFrame([("a", None), ("a", (None, None)), ("a", (1, None)), ("b", (1, 2))], f"collection string, timespan {span}")
    places = spark.createDataFrame([("a", 2), ("b", 4)], "name string, type byte")
    assert rows_of(collection_units(entries, places)) == [("a", 2, 3, 2), ("b", 4, 1, 0)]
    ids = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows_of(duplicate_ids(ids, "id")) == [(1, 2)]
    wanted = spark.createDataFrame([("x",), ("y",), ("y",)], "name string")
    assert rows_of(missing_types(wanted, wanted.where("name = 'x'"))) == [("y",)]


def test_dimension_spec():
    assert STANDARD_SPEC.required(["visit", "detector"]) == ["instrument", "visit", "detector"]
    assert STANDARD_SPEC.required(["patch", "band"]) == ["skymap", "tract", "patch", "band"]
    assert STANDARD_SPEC.dataset_schema([]).names == ["dataset_id", "run"]
    assert "band" not in [d.name for d in STANDARD_SPEC.stored()]
    assert STANDARD_SPEC.stored_name("band") == "physical_filter"
    assert STANDARD_SPEC.record_schema("visit_definition").names == ["instrument", "exposure", "visit"]
    assert STANDARD_SPEC.key_columns("exposure") == ["instrument", "id"]
    stages = STANDARD_SPEC.load_order(["visit_definition", "visit", "exposure", "instrument", "physical_filter", "day_obs", "group"])
    assert stages[0] == ["instrument"] and stages[-1] == ["visit_definition"]
    with pytest.raises(KeyError):
        STANDARD_SPEC["nothing"]
