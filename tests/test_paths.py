"""Path algebra, globs and text."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from releasecat.functions.formatting import decimal_size
from releasecat.functions.globs import glob_to_regex
from releasecat.functions.identifiers import binary_to_uuid, uuid_to_binary
from releasecat.operators.paths import (
    AmbiguousRootError,
    file_list,
    make_paths_absolute,
    map_to_datastores,
    unknown_roots,
    unmapped_paths,
)
from releasecat.operators.selection import (
    UnmatchedPatternError,
    resolve_names,
    rewrite_columns,
    select_types,
    unmatched_globs,
)
from releasecat.operators.validation import ReleaseCheckError, paths_outside, require_none
from releasecat.sinks.fetch import fetch_batches, fetch_scalar


def records(spark, *rows):
    return spark.createDataFrame(list(rows), "datastore_name string, path string")


def pairs(df):
    return [(r["datastore_name"], r["path"]) for r in df.collect()]


SCHEMES = ("file://", "s3://", "gs://", "https://")


def made_up(generator, count):
    """Stores with roots, and records with relative paths, URIs and fragments, all drawn from a seed."""
    word = lambda: "".join(generator.choices("pqré _-.%", k=generator.randint(1, 5)))
    stores = {f"store{n}": generator.choice(SCHEMES) + word() + generator.choice(["", "/", "//"]) for n in range(6)}
    rows = []
    for number in range(count):
        path = "/".join(word() for _ in range(generator.randint(1, 4)))
        if generator.random() < 0.4:
            path = generator.choice(SCHEMES) + path
        if generator.random() < 0.3:
            path += "#" + word()
        rows.append((generator.choice([*stores, "nowhere"]), path))
    return stores, rows


def rooted(stores, name, path):
    """The rule in plain Python: URIs stay, other paths follow the root after one slash."""
    if "://" in path and "/" not in path.split("://")[0] and ":" not in path.split("://")[0] and path.split("://")[0]:
        return path
    return stores[name].rstrip("/") + "/" + path if name in stores else None


@pytest.mark.parametrize("form", ["literal", "table", "longer"])
def test_roots(spark, form):
    stores, rows = made_up(random.Random(11), 300)
    df = records(spark, *rows).withColumn("given", F.col("path"))
    roots = stores
    if form == "table":
        roots = spark.createDataFrame([*stores.items(), *stores.items()], "datastore_name string, root string")
    elif form == "longer":
        roots = {**stores, **{f"unused{n}": "s3://u" for n in range(1000)}}
    found = make_paths_absolute(df, roots).collect()
    assert len(found) == len(rows)
    assert all(r["path"] == rooted(stores, r["datastore_name"], r["given"]) for r in found)
    missing = sorted(pairs(unknown_roots(df.select("datastore_name", "path"), roots)))
    assert missing == sorted(r for r in rows if rooted(stores, *r) is None)
    with pytest.raises(ReleaseCheckError, match="Roots"):
        require_none(unknown_roots(df, roots), "Roots are missing")


def test_a_store_with_two_roots_is_an_error(spark):
    table = spark.createDataFrame([("a", "s3://x"), ("a", "s3://y")], "datastore_name string, root string")
    with pytest.raises(AmbiguousRootError, match="'a'"):
        make_paths_absolute(records(spark, ("a", "p")), table)


def mapped(mapping, uri):
    """The rule in plain Python: the first prefix in order, wherever it ends."""
    for prefix, name in mapping.items():
        if uri.startswith(prefix):
            return name, uri[len(prefix) :].lstrip("/")
    return None, None


@pytest.mark.parametrize("size", [1, 10, 64, 65, 1000])
@pytest.mark.parametrize("form", ["literal", "table"])
def test_prefixes(spark, form, size):
    generator = random.Random(size)
    uris = [generator.choice(SCHEMES) + "".join(generator.choices("ab/é", k=generator.randint(0, 8))) for _ in range(200)]
    mapping = {}
    while len(mapping) < size:
        start = generator.choice(uris)
        prefix = start[: generator.randint(5, len(start))] if len(mapping) % 2 else start + f"/{len(mapping)}"
        mapping.setdefault(prefix if len(mapping) < 100 else f"{prefix}{len(mapping)}", f"n{len(mapping)}")
    table = mapping
    if form == "table":
        rows = [(p, n, i) for i, (p, n) in enumerate(mapping.items())]
        table = spark.createDataFrame(rows, "prefix string, datastore_name string, position int")
    df = records(spark, *[("x", u) for u in uris]).withColumn("uri", F.col("path"))
    result = map_to_datastores(df, table)
    found = result.collect()
    assert len(found) == len(uris)
    assert all((r["datastore_name"], r["path"]) == mapped(mapping, r["uri"]) for r in found)
    strays = unmapped_paths(df.select("datastore_name", "path"), table)
    assert sorted(p for _, p in pairs(strays)) == sorted(u for u in uris if mapped(mapping, u)[0] is None)
    plan = result._jdf.queryExecution().executedPlan().toString()
    if form == "literal":
        assert "Exchange" not in plan and "Join" not in plan
    else:
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_mapping_undoes_roots(spark):
    roots = {f"s{n}": f"s3://bucket{n}x" for n in range(20)}
    rows = [(f"s{n % 20}", f"{n}/é#{n}") for n in range(100)]
    back = map_to_datastores(make_paths_absolute(records(spark, *rows), roots), {r: s for s, r in roots.items()})
    assert sorted(pairs(back)) == sorted(rows)


def test_physical_files(spark):
    generator = random.Random(3)
    tables = [
        [f"f{generator.randint(0, 30)}" + generator.choice(["", "#", "#m1", "#m2#x"]) for _ in range(size)]
        for size in (80, 40, 1)
    ]
    files = file_list(*[spark.createDataFrame([(p,) for p in paths], "path string") for paths in tables])
    expected = {p.split("#")[0] for paths in tables for p in paths}
    assert sorted(r["file"] for r in files.collect()) == sorted(expected)
    fetched = list(fetch_batches(files, 7))
    assert [len(batch) for batch in fetched[:-1]] == [7] * (len(expected) // 7) and len(fetched[-1]) <= 7
    assert sorted(f for batch in fetched for f in batch) == sorted(expected)
    assert fetch_scalar(files.agg(F.count(F.lit(1)))) == len(expected)
    with pytest.raises(ValueError):
        fetch_scalar(files.where("false"))
    with pytest.raises(ValueError):
        list(fetch_batches(files.withColumn("other", F.lit(1)), 7))


def test_globs_match_like_the_shell(spark):
    generator = random.Random(7)
    letters = "ab-]![^.*?\\&x_ é"
    names = ["".join(generator.choices(letters, k=generator.randint(0, 6))) for _ in range(60)]
    globs = ["".join(generator.choices("ab-]![^*?.&\\x", k=generator.randint(0, 7))) for _ in range(150)]
    globs += ["[a-c]x", "[!a]*", "[]]", "[!]]", "[^a]", "[c-a]", "[!c-a]", "a[", "*", "", "[a&&b]*", "A*"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    flags = df.select("name", *[F.col("name").rlike(glob_to_regex(g)).alias(f"g{i}") for i, g in enumerate(globs)])
    for row in flags.collect():
        for i, g in enumerate(globs):
            assert row[f"g{i}"] == fnmatch.fnmatchcase(row["name"], g), (row["name"], g)


def test_selection_by_glob(spark):
    df = spark.createDataFrame([(n,) for n in ["t1", "t2", "map_min", "map_sum", "Map"]], "name string")
    assert [r["name"] for r in select_types(df, ["map*", "*_min", "t[2-9]"]).collect()] == ["t2", "map_min", "map_sum"]
    assert [r["pattern"] for r in unmatched_globs(df, ["fish*", "t?", "u"]).collect()] == ["fish*", "u"]
    with pytest.raises(UnmatchedPatternError, match="fish.*'u'"):
        resolve_names(df, ["fish*", "t?", "u"])
    assert resolve_names(df, []).count() == 0


def test_rewrite_by_a_python_function_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "n", "a", b"\x01"), (2, "m", "b", None)], "id int, datastore_name string, path string, raw binary")

    def shout(rows):
        for row in rows:
            row["path"] = row["path"].upper() + row["datastore_name"]

    result = rewrite_columns(df, shout)
    assert result.schema == df.schema
    assert [(r["id"], r["path"], r["raw"]) for r in result.collect()] == [(1, "An", bytearray(b"\x01")), (2, "Bm", None)]


def test_paths_that_leave_the_directory(spark):
    inside = ["a", "a/b", "./a", "a/../b", "a//b", "..a/b"]
    outside = ["../a", "a/../../b", "/etc/x", "..", ".", "a/..", ""]
    df = spark.createDataFrame([(p,) for p in inside + outside], "file string")
    assert sorted(r["file"] for r in paths_outside(df).collect()) == sorted(outside)


def _expected_size(size):
    if size == 1:
        return "1 byte"
    if size < 1000:
        return f"{size} bytes"
    power = 1
    while size >= 1000 ** (power + 1) and power < 8:
        power += 1
    return f"{size / 1000**power:,.1f} {['kB', 'MB', 'GB', 'TB', 'PB', 'EB', 'ZB', 'YB'][power - 1]}"


def test_sizes_as_text(spark):
    sizes = [0, 1, 2, 999, 1000, 1050, 1150, 1250, 1350, 999_949, 999_950, 999_999, 10**6, 123_456_789, 10**15, 10**24]
    sizes += [10**28 + 5 * 10**24, 25 * 10**22]
    df = spark.createDataFrame([(str(s),) for s in sizes], "s string").select(F.col("s").cast("decimal(38,0)").alias("size"))
    texts = [r["text"] for r in df.select(decimal_size("size").alias("text")).collect()]
    assert texts == [_expected_size(s) for s in sizes]


def test_uuid_round_trip(spark):
    text = "0f8fad5b-d9cb-469f-a165-70867728950e"
    df = spark.createDataFrame([(text,)], "id string")
    assert df.select(binary_to_uuid(uuid_to_binary("id")).alias("id")).first()["id"] == text
