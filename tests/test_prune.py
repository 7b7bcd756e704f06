"""Pruning, value removal and rewrites in place."""

import shutil

import pytest

from releasecat import fs
from releasecat.operators.prune import (
    dangling_definitions,
    prune_unreferenced,
    referenced_keys,
    remove_value,
)
from releasecat.plans.transform import prune_release, remove_value_from_release
from releasecat.registry import adapters, dump_queries
from releasecat.schemas import as_nullable
from releasecat.session import staging_path
from releasecat.sinks.rewrite import recover_table, remove_replaced, rewrite_table, rewrite_tables
from releasecat.sources.release import Release


@pytest.fixture
def tables(spark):
    """Visit 1 is in a data ID, visit 2 is reached through exposure 20, visit 3 not at all."""
    return {
        "visit": spark.createDataFrame([("cam", v) for v in (1, 2, 3)] + [("other", 1)], "instrument string, id long"),
        "exposure": spark.createDataFrame(
            [("cam", e) for e in (10, 11, 20, 21, 30)], "instrument string, id long"
        ),
        "visit_definition": spark.createDataFrame(
            # Exposure 21 is a sibling of 20; one row occurs twice.
            [("cam", 10, 1), ("cam", 11, 1), ("cam", 20, 2), ("cam", 20, 2), ("cam", 21, 2), ("cam", 30, 3)],
            "instrument string, exposure long, visit long",
        ),
        "visit_system_membership": spark.createDataFrame(
            [("cam", v, s) for v in (1, 2, 3) for s in (0, 2)], "instrument string, visit long, visit_system long"
        ),
    }


@pytest.fixture
def keys(spark, tables):
    datasets = spark.createDataFrame(
        [("cam", 1, None), ("cam", None, 20), ("cam", None, None), (None, None, None)],
        "instrument string, visit long, exposure long",
    )
    return referenced_keys(datasets, tables["visit_definition"])


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_one_step_closure(keys):
    assert sorted(rows_of(keys.visits)) == [("cam", 1), ("cam", 2)]
    assert sorted(rows_of(keys.exposures)) == [("cam", 10), ("cam", 11), ("cam", 20)]


def test_pruned_tables_are_sorted_and_complete(tables, keys):
    pruned = prune_unreferenced(tables, keys)
    assert rows_of(pruned["visit"]) == [("cam", 1), ("cam", 2)]
    assert rows_of(pruned["exposure"]) == [("cam", 10), ("cam", 11), ("cam", 20)]
    assert rows_of(pruned["visit_system_membership"].select("visit")) == [(1,), (1,), (2,), (2,)]
    assert sorted(rows_of(pruned["visit_definition"])) == [("cam", 10, 1), ("cam", 11, 1), ("cam", 20, 2), ("cam", 21, 2)]
    assert rows_of(dangling_definitions(pruned["visit_definition"], pruned["exposure"])) == [("cam", 21, 2)]


def test_pruning_twice_changes_nothing(tables, keys):
    once = prune_unreferenced(tables, keys)
    twice = prune_unreferenced(once, keys)
    assert {n: sorted(rows_of(t)) for n, t in once.items()} == {n: sorted(rows_of(t)) for n, t in twice.items()}


def test_a_removed_value_takes_its_dependents_along(spark):
    records = {"maps": (spark.createDataFrame([("v1",), ("v2",), (None,)], "name string"), "name")}
    datasets = spark.createDataFrame([(1, "v1"), (2, "v2"), (3, None)], "dataset_id int, map string")
    files = {"files": spark.createDataFrame([(1,), (1,), (2,), (3,), (4,)], "dataset_id int")}
    kept_records, kept_datasets, kept_files = remove_value(records, datasets, files, "map", "v1")
    assert rows_of(kept_records["maps"]) == [("v2",)]
    assert rows_of(kept_datasets) == [(2, "v2")]
    assert rows_of(kept_files["files"]) == [(2,)]


def test_a_table_can_be_rewritten_from_itself(spark):
    path = staging_path(spark, "table")
    spark.range(5).write.parquet(path)
    schema = spark.read.parquet(path).schema
    rewrite_table(spark, path, lambda df: df.where("id > 2").selectExpr("CAST(id AS INT) AS id"), schema)
    assert spark.read.parquet(path).schema == as_nullable(schema)
    assert sorted(rows_of(spark.read.parquet(path))) == [(3,), (4,)]


def test_tables_rewritten_from_one_another_see_the_old_rows(spark):
    first, second = staging_path(spark, "first"), staging_path(spark, "second")
    for path in (first, second):
        spark.range(6).write.parquet(path)
    schema = spark.read.parquet(first).schema
    rewrite_tables(
        spark,
        {
            first: (lambda df: df.where("id < 2"), schema),
            second: (lambda df: df.join(spark.read.parquet(first), "id", "left_semi"), schema),
        },
    )
    assert spark.read.parquet(first).count() == 2
    assert spark.read.parquet(second).count() == 6


def test_a_failed_rewrite_leaves_all_tables(spark):
    first, second = staging_path(spark, "first"), staging_path(spark, "second")
    for path in (first, second):
        spark.range(3).write.parquet(path)
    schema = spark.read.parquet(first).schema
    with pytest.raises(Exception, match="oops"):
        rewrite_tables(
            spark,
            {
                first: (lambda df: df.where("id < 1"), schema),
                second: (lambda df: df.selectExpr("CASE WHEN id < 9 THEN raise_error('oops') END AS id"), schema),
            },
        )
    assert spark.read.parquet(first).count() == 3
    assert spark.read.parquet(second).count() == 3


def test_a_broken_swap_is_recovered(spark):
    path = staging_path(spark, "table")
    spark.range(3).write.parquet(path)
    fs.rename(spark, path, path + ".__replaced")
    recover_table(spark, path)
    assert spark.read.parquet(path).count() == 3
    spark.range(9).write.parquet(path + ".__replaced")
    recover_table(spark, path)
    assert spark.read.parquet(path).count() == 3
    assert not fs.exists(spark, path + ".__replaced")


def test_release_is_pruned_in_place_once(spark, sf_dir):
    release = dump_queries.write_release(spark, sf_dir)
    before = release.read_dimension("visit_definition").count()
    remove_value_from_release(release, {"skymap": "name", "tract": "skymap"}, ["sky_map"], "skymap", "ASIA")
    assert release.read_datasets("sky_map").count() == 4
    assert release.read_dimension("tract").where("skymap = 'ASIA'").count() == 0
    prune_release(release)
    names = ("visit", "exposure", "visit_definition")
    once = {n: release.read_dimension(n).count() for n in names}
    assert once["visit_definition"] <= before
    prune_release(release)
    assert {n: release.read_dimension(n).count() for n in names} == once
    assert adapters.ROOTS


def _contents(release):
    tables = {n: release.read_dimension(n) for n in ("visit", "exposure", "visit_definition", "skymap", "tract")}
    tables |= {"maps": release.read_datasets("sky_map"), "files": release.read_datastore("sky_map")}
    return {n: sorted(map(str, rows_of(df))) for n, df in tables.items()}


def test_all_tables_of_a_release_change_by_one_switch(spark, sf_dir, monkeypatch):
    written = dump_queries.write_release(spark, sf_dir)

    def remove(release):
        remove_value_from_release(release, {"skymap": "name", "tract": "skymap"}, ["sky_map"], "skymap", "ASIA")

    def copied():
        copy = staging_path(spark, "copy")
        shutil.copytree(written.directory.removeprefix("file:"), copy.removeprefix("file:"))
        return Release(spark, copy, written.spec)

    def fresh(release):
        return _contents(Release(spark, release.directory, release.spec))

    whole = copied()
    old, early = _contents(whole), Release(spark, whole.directory, whole.spec)
    assert early.header and early.types
    remove(whole)
    removed = _contents(whole)
    assert removed != old and fresh(whole) == removed
    # Who has read the manifest before still has all old tables.
    assert _contents(early) == old
    prune_release(whole)
    expected = _contents(whole)
    assert fresh(whole) == expected and _contents(early) == old
    remove_replaced(whole)
    assert fresh(whole) == expected
    named = {path.removeprefix(f"{whole.directory}/") for path in whole.all_paths()}
    top = {n for n in fs.list_names(spark, whole.directory) if n.endswith(".parquet")}
    assert top == {n for n in named if "/" not in n}

    for step in ("write_text", "replace_text"):
        release = copied()
        kept = getattr(fs, step)

        def fail(session, path, text, kept=kept):
            raise OSError("cut short")

        with monkeypatch.context() as patched:
            patched.setattr(fs, step, fail)
            with pytest.raises(OSError, match="cut short"):
                remove(release)
        assert fresh(release) == _contents(release) == old
        remove(release)
        assert fresh(release) == removed
        remove_replaced(release)
        assert fresh(release) == removed and fs.list_names(spark, f"{release.directory}/versions") == ["000002"]


def test_text_is_replaced(spark):
    path = f"{staging_path(spark, 'text')}/a.json"
    for text in ("one", "two, longer", "é"):
        fs.replace_text(spark, path, text)
        assert fs.read_text(spark, path) == text
    assert [n for n in fs.list_names(spark, path.rsplit("/", 1)[0]) if not n.startswith(".")] == ["a.json"]
