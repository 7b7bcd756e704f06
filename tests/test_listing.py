"""File listings by tasks, sizes of named files, and many prefixes at once."""

import random

import pytest

from releasecat.functions.prefixes import PrefixIndex
from releasecat.operators import paths as path_operators
from releasecat.operators.paths import map_to_datastores
from releasecat.operators.summary import footer_count_report, release_summary, unlisted_files
from releasecat.session import staging_path
from releasecat.sources.listing import file_sizes, list_files, open_uri


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    sizes = {"a.dat": 3, "b c+d%20é.txt": 5, "x/a.dat": 0, "x/y/z/deep.dat": 70, "x/y/e.txt": 9, "_hidden": 1, ".dot": 1, "x/_temporary/f": 1}
    for name, size in sizes.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"." * size)
    (root / "empty").mkdir()
    return root, {f"file://{root}/{n}": s for n, s in sizes.items() if not n.startswith(("_", ".")) and "/_" not in n}


def test_every_level_is_listed(spark, tree):
    root, sizes = tree
    assert {r["file"]: r["size"] for r in list_files(spark, str(root)).collect()} == sizes
    assert {r["file"]: r["size"] for r in list_files(spark, f"file:{root}/").collect()} == sizes
    some = {f: s for f, s in sizes.items() if f.endswith(".dat")}
    assert {r["file"]: r["size"] for r in list_files(spark, f"file://{root}", "*.d[a-c]t").collect()} == some
    assert [tuple(r) for r in list_files(spark, f"{root}/a.dat").collect()] == [(f"file://{root}/a.dat", 3)]
    assert list_files(spark, f"{root}/empty").count() == 0
    with pytest.raises(FileNotFoundError):
        list_files(spark, f"{root}/none")


def test_sizes_of_named_files(spark, tree):
    root, sizes = tree
    names = [*sizes, f"{root}/a.dat", f"file:{root}/x/y/e.txt", f"{root}/none", f"file://{root}/x", None]
    table = spark.createDataFrame([(i, n, 8) for i, n in enumerate(names)], "id int, file string, size int").repartition(3)
    found = {r["id"]: r["size"] for r in file_sizes(table).collect()}
    assert [found[i] for i in range(len(names))] == [*sizes.values(), 3, 9, None, None, None]
    assert open_uri("file:///a/b")[1] == open_uri("file:/a/b")[1] == "/a/b"


def test_files_of_unknown_size_are_reported(spark):
    records = spark.createDataFrame(
        [("t", "a", 5), ("t", "b#1", None), ("t", "b#2", None), ("t", "c", None), ("u", "c", None), ("v", "d", 1)],
        "dataset_type string, path string, file_size long",
    )
    datasets = spark.createDataFrame([("t",), ("u",), ("w",)], "dataset_type string")
    listing = spark.createDataFrame([("b", 50)], "file string, size long")
    columns = ("dataset_type", "files", "bytes", "files_without_size")
    rows = lambda df: sorted((r[0], r[1], int(r[2]), r[3]) for r in df.select(*columns).collect())
    assert rows(release_summary(datasets, records, listing)) == [("t", 3, 55, 1), ("u", 1, 0, 1), ("v", 1, 1, 0), ("w", 0, 0, 0)]
    assert rows(release_summary(datasets, records)) == [("t", 3, 5, 2), ("u", 1, 0, 1), ("v", 1, 1, 0), ("w", 0, 0, 0)]
    assert [r["file"] for r in unlisted_files(records, listing).collect()] == ["c"]


def test_counts_come_from_footers(spark):
    paths = {}
    for name, rows in (("none", 0), ("few", 7), ("many", 5000)):
        paths[name] = staging_path(spark, name)
        spark.range(0, rows, 1, 3).write.parquet(paths[name])
    report = footer_count_report(spark, paths, {"few": "id long"})
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3
    assert {r["name"]: r["n_rows"] for r in report.collect()} == {"none": 0, "few": 7, "many": 5000}
    # Tables opened afterwards are read as before.
    assert "FileScan parquet" in spark.read.parquet(paths["few"])._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(5))
def test_index_against_all_prefixes(seed):
    pick = random.Random(seed)
    word = lambda most: "".join(pick.choice("ab\U0001F600é") for _ in range(pick.randint(0, most)))
    entries = [(position, word(7), f"n{position}") for position in pick.sample(range(500), 300)]
    index = PrefixIndex(entries)
    for text in [word(12) for _ in range(500)] + ["", "zzz"]:
        fits = [(position, name, len(prefix)) for position, prefix, name in entries if text.startswith(prefix)]
        assert index.find(text) == (min(fits) if fits else None)
    assert PrefixIndex([]).find("x") is None


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_many_prefixes_leave_records_in_place(spark, monkeypatch, limit):
    monkeypatch.setattr(path_operators, "INDEX_PREFIXES", limit)
    mapping = {f"s3://b{n % 50}/{'d/' * (n % 7)}{n}": f"n{n}" for n in range(200)} | {"s3://b1": "first", "": "rest"}
    rows = [(f"s3://b{n % 60}/{'d/' * (n % 7)}{n}/f",) for n in range(300)] + [(None,), ("",)]
    records = spark.createDataFrame(rows, "path string").withColumn("datastore_name", path_operators.F.lit("x"))
    table = spark.createDataFrame([(p, n, i) for i, (p, n) in enumerate(mapping.items())], "prefix string, datastore_name string, position int")
    results = [map_to_datastores(records, form) for form in (mapping, table)]
    found = [sorted((str(r["datastore_name"]), str(r["path"])) for r in result.collect()) for result in results]
    assert found[0] == found[1]
    assert "Exchange" not in results[0]._jdf.queryExecution().executedPlan().toString()
    if limit:
        assert "Exchange" not in results[1]._jdf.queryExecution().executedPlan().toString()


def test_records_move_once_however_many_lengths_prefixes_have(spark, monkeypatch):
    monkeypatch.setattr(path_operators, "INDEX_PREFIXES", 0)
    pick = random.Random(3)
    words = ["".join(pick.choice("ab\U0001F600é") for _ in range(pick.randint(0, 40))) for _ in range(600)]
    nested = ["a" * n for n in range(0, 60, 3)]
    entries = [(p, prefix, f"n{p}") for p, prefix in enumerate(pick.sample(sorted({*words[:300], *nested}), 300))]
    texts = [*words, *[w + "/f" for w in words], *["a" * n + "z" for n in range(80)], *["aab"] * 500, "", None]
    records = spark.createDataFrame(list(enumerate(texts)), "n long, path string").repartition(5)
    table = spark.createDataFrame([(None, None, "none"), *entries], "position int, prefix string, datastore_name string")
    index = PrefixIndex(entries)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # More ranges than there are texts of some beginnings, so that prefixes reach over several of them.
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        mapped = path_operators._with_mapping(records, table, "path")
        found = {r["n"]: r["__fit"] and tuple(r["__fit"]) for r in mapped.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == {n: text if text is None else index.find(text) for n, text in enumerate(texts)}
    assert "SortMergeJoin" not in mapped._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
