"""Collections, search, export and the round trip through a load."""

import random
import shutil
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from releasecat import fs
from releasecat.functions.identifiers import binary_to_hex
from releasecat.operators.collections import (
    CollectionCycleError,
    MissingCollectionError,
    add_alias_chain,
    chain_edges,
    flatten_collections,
)
from releasecat.operators.joins import fill_sizes
from releasecat.operators.paths import map_to_datastores
from releasecat.operators.progress import fold_progress
from releasecat.operators.selection import UnmatchedPatternError
from releasecat.operators.validation import ReleaseCheckError, null_violations, schema_differences
from releasecat.plans.export import export_release
from releasecat.plans.load import Steps, check_release, dataset_orphans, load_release, record_orphans, stray_rows
from releasecat.plans.summary import dataset_counts, dimension_counts, summarize, summary_text, write_summary
from releasecat.plans.transfer import transfer_plan
from releasecat.plans.transform import change_storage_class
from releasecat.schemas import COLLECTIONS, DATASTORE, STANDARD_SPEC, TIMESPAN
from releasecat.session import staging_path
from releasecat.sinks.rewrite import rewrite_table
from releasecat.sources.catalog import Catalog
from releasecat.sources.listing import list_files
from releasecat.sources.release import Release, manifest_files

DAY = 86_400_000_000_000


def key(name):
    return uuid.uuid5(uuid.NAMESPACE_URL, name).bytes


def collections_of(spark, *rows):
    return spark.createDataFrame([(n, t, "", list(c)) for n, t, c in rows], COLLECTIONS)


def order_of(df):
    return [r["name"] for r in df.orderBy("search_rank").collect()]


def test_chains_flatten_depth_first(spark):
    table = collections_of(
        spark, ("top", 3, ["r1", "inner"]), ("inner", 3, ["tag", "cal"]), ("r1", 1, []), ("tag", 2, []), ("cal", 4, [])
    )
    flat = flatten_collections(table, ["top"])
    assert order_of(flat) == ["top", "r1", "inner", "tag", "cal"]
    assert [r["search_rank"] for r in flat.orderBy("search_rank").collect()] == [0, 1, 2, 3, 4]


def test_first_occurrence_wins_even_if_it_is_deeper(spark):
    table = collections_of(
        spark,
        ("top", 3, ["a", "x", "b"]),
        ("a", 3, ["b"]),
        ("b", 3, ["x", "y"]),
        ("x", 1, []),
        ("y", 1, []),
        ("z", 1, []),
    )
    assert order_of(flatten_collections(table, ["top"])) == ["top", "a", "b", "x", "y"]
    assert order_of(flatten_collections(table, ["z", "b", "top"])) == ["z", "b", "x", "y", "top", "a"]


def test_many_ways_to_one_collection_stay_cheap(spark):
    # 3**7 paths lead to the last one.
    rows = [(f"c{n}", 3, [f"c{n + 1}"] * 3) for n in range(7)] + [("c7", 1, [])]
    assert order_of(flatten_collections(collections_of(spark, *rows), ["c0"])) == [f"c{n}" for n in range(8)]


def test_more_ways_than_a_recursive_query_returns(spark):
    assert spark.conf.get("spark.sql.cteRecursionLevelLimit") == "-1"
    rows = [(f"c{n}", 3, [f"c{n + 1}", "side"] * 3) for n in range(6)] + [("c6", 1, []), ("side", 3, ["end"]), ("end", 1, [])]
    limit = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(limit, "100")
    try:
        assert order_of(flatten_collections(collections_of(spark, *rows), ["c0"])) == [f"c{n}" for n in range(7)] + ["side", "end"]
        with pytest.raises(CollectionCycleError, match="c0 -> c1 -> c2 -> c3 -> c4 -> c5 -> c0"):
            flatten_collections(collections_of(spark, *rows[:5], ("c5", 3, ["c0", "c0", "c0"]), *rows[7:]), ["c0"])
    finally:
        spark.conf.unset(limit)


def test_cycles_and_missing_collections_are_errors(spark):
    table = collections_of(spark, ("a", 3, ["b"]), ("b", 3, ["c"]), ("c", 3, ["b"]), ("d", 3, ["gone"]))
    with pytest.raises(CollectionCycleError, match="a -> b -> c -> b"):
        flatten_collections(table, ["a"])
    with pytest.raises(MissingCollectionError, match="nowhere"):
        flatten_collections(table, ["nowhere"])
    with pytest.raises(MissingCollectionError, match="gone"):
        flatten_collections(table, ["d"])


def test_links_keep_their_order(spark):
    table = collections_of(spark, ("top", 3, ["z", "a", "m"]), ("other", 3, ["a"]), ("a", 1, ["ignored"]))
    edges = chain_edges(table)
    assert edges.count() == 4
    assert rows_of(edges, "parent", "position", "child")[1:] == [("top", 0, "z"), ("top", 1, "a"), ("top", 2, "m")]
    alias = add_alias_chain(table, "top", "short").where("name = 'short'").first()
    assert (alias["type"], alias["children"]) == (3, ["z", "a", "m"])


class Sky:
    """A made-up catalog, drawn from a seed, and what a release of it must hold, worked out in plain Python."""

    TYPES = {
        "flux": (("instrument", "visit"), False),
        "flux:raw": (("instrument", "visit"), False),
        "mask": (("instrument", "detector"), False),
        "bias": (("instrument", "detector"), True),
        "void": (("instrument", "detector"), False),
        "log": ((), False),
    }
    CHAINS = {"survey": ["deep", "run2", "wide"], "deep": ["pick1", "inner"], "inner": ["run0", "bias0"], "wide": ["pick2", "bias1", "run0"]}
    #: Depth first, first occurrence.
    ORDER = ["survey", "deep", "pick1", "inner", "run0", "bias0", "run2", "wide", "pick2", "bias1"]
    WANTED, PROVENANCE = ["flux*", "mask", "bi?s", "void"], ["lo[f-h]"]

    def __init__(self, seed=20):
        draw = random.Random(seed)
        self.datasets, self.members, self.records = [], [], []
        for number in range(240):
            kind = draw.choice(["flux", "flux", "flux:raw", "mask", "bias"])
            site, run = draw.choice(["north", "south"]), f"run{draw.randint(0, 5)}"
            visit = draw.randint(1, 12) if kind.startswith("flux") else None
            detector = None if visit else draw.randint(1, 9)
            self.datasets.append((f"{kind}{number}", kind, run, site, visit, detector))
        self.datasets += [(f"log{n}", "log", f"run{n}", None, None, None) for n in range(6)]
        for name, kind, *_ in self.datasets[:240]:
            for pick in ("pick1", "pick2", "pick3"):
                if draw.random() < 0.08:
                    self.members.append((name, pick, None))
            if kind == "bias" and draw.random() < 0.5:
                start = draw.randint(0, 99) * DAY
                self.members.append((name, draw.choice(["bias0", "bias1", "bias2"]), (start, start + DAY)))
        for name, kind, *_ in self.datasets:
            for part in range(draw.choice([1, 1, 2])):
                path = f"{kind}/{name}.dat" if part == 0 else f"gs://pool/{draw.randint(0, 5)}.tar#{name}"
                self.records.append((draw.choice(["near", "far"]), name, path, draw.choice([None, 1, 70])))
        self.roots = {"near": "file:///n", "far": "file:///f/"}

    def rank(self, dataset):
        places = [dataset[2], *[c for name, c, _ in self.members if name == dataset[0]]]
        return min((self.ORDER.index(c) for c in places if c in self.ORDER), default=None)

    def selected(self):
        """Names of the datasets of a release, by type."""
        found = {kind: [] for kind in self.TYPES}
        best = {}
        for dataset in self.datasets:
            rank, kind = self.rank(dataset), dataset[1]
            if rank is None or kind == "log":
                continue
            if self.TYPES[kind][1]:
                found[kind].append(dataset[0])
            else:
                best.setdefault((kind, *dataset[3:]), []).append((rank, key(dataset[0]), dataset[0]))
        for (kind, *_), candidates in best.items():
            found[kind].append(min(candidates)[2])
        runs = {d[2] for d in self.datasets if d[0] in sum(found.values(), [])} | set(self.ORDER)
        found["log"] = [d[0] for d in self.datasets if d[1] == "log" and d[2] in runs]
        return found

    def runs(self):
        chosen = set(sum(self.selected().values(), []))
        return {d[2] for d in self.datasets if d[0] in chosen}

    def path(self, store, path):
        return path if "://" in path else f"{self.roots[store].rstrip('/')}/{path}"

    def catalog(self, spark):
        wide = "dataset_id binary, dataset_type string, run string, instrument string, visit long, detector long"
        types = "name string, storageClass string, dimensions array<string>, parentStorageClass string, isCalibration boolean"
        record = STANDARD_SPEC.record_schema
        plain = [(f"run{n}", 1, []) for n in range(6)] + [(f"pick{n}", 2, []) for n in (1, 2, 3)] + [(f"bias{n}", 4, []) for n in (0, 1, 2)]
        return Catalog(
            dataset_types=spark.createDataFrame([(n, "Frame", list(d), None, c) for n, (d, c) in self.TYPES.items()], types),
            datasets=spark.createDataFrame([(key(n), *rest) for n, *rest in self.datasets], wide),
            collections=collections_of(spark, *plain, *[(n, 3, c) for n, c in self.CHAINS.items()]),
            memberships=spark.createDataFrame([(key(n), c, t) for n, c, t in self.members], f"dataset_id binary, collection string, timespan {TIMESPAN.simpleString()}"),
            datastore=spark.createDataFrame([(s, key(n), p, "fmt", "Frame", None, None, z) for s, n, p, z in self.records], DATASTORE),
            dimensions={
                "instrument": spark.createDataFrame([(n, 1, 2, 3, 4, "pkg.Eye") for n in ("north", "south")], record("instrument")),
                "day_obs": spark.createDataFrame([("north", n, (n * DAY, (n + 1) * DAY)) for n in range(5)], record("day_obs")),
                "visit_detector_region": spark.createDataFrame([("south", n, 1, bytes([n, 0])) for n in range(4)], record("visit_detector_region")),
            },
            roots=self.roots,
            dimension_config="kinds: 3\n",
        )


@pytest.fixture(scope="module")
def sky():
    return Sky()


@pytest.fixture(scope="module")
def catalog(spark, sky):
    return sky.catalog(spark)


@pytest.fixture(scope="module")
def release(spark, sky, catalog):
    return export_release(catalog, staging_path(spark, "release"), sky.WANTED, sky.PROVENANCE, ["survey"])


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def ordered(rows):
    return sorted(rows, key=str)


def test_the_scenario_has_shadowed_calibrated_and_unreachable_datasets(sky):
    found = sky.selected()
    assert found["void"] == [] and all(found[kind] for kind in found if kind != "void")
    reachable = [d for d in sky.datasets if sky.rank(d) is not None and d[1].startswith("flux")]
    assert len(found["flux"]) + len(found["flux:raw"]) < len(reachable) < len(sky.datasets)
    assert sky.runs() - set(sky.ORDER)


def test_datasets(sky, release):
    rows = {d[0]: d for d in sky.datasets}
    for kind, names in sky.selected().items():
        found = release.read_datasets(kind)
        dimensions = list(sky.TYPES[kind][0])
        assert found.columns == ["dataset_id", "run", *dimensions]
        places = {"instrument": 3, "visit": 4, "detector": 5}
        expected = [(key(n), rows[n][2], *[rows[n][places[c]] for c in dimensions]) for n in names]
        assert rows_of(found, *found.columns) == ordered(expected)
        assert release.read_dataset_ids(kind).columns == ["dataset_id"]


def test_collections(sky, release):
    found = {r["name"]: r["children"] for r in release.read_collections().collect()}
    assert found == {name: sky.CHAINS.get(name, []) for name in {*sky.ORDER, *sky.runs()}}


def test_associations(sky, release):
    for kind, names in sky.selected().items():
        found = release.read_associations(kind)
        assert found.columns[-2:] == ["collection", "timespan"]
        expected = [(key(n), c, *(t or (None, None))) for n, c, t in sky.members if n in names and c in sky.ORDER]
        assert rows_of(found, "dataset_id", "collection", "timespan.begin_nsec", "timespan.end_nsec") == ordered(expected)
        assert found.where("timespan IS NULL").count() == 0


def test_file_records(sky, release):
    for kind, names in sky.selected().items():
        expected = [(s, key(n), sky.path(s, p), z) for s, n, p, z in sky.records if n in names]
        assert rows_of(release.read_datastore(kind), "datastore_name", "dataset_id", "path", "file_size") == ordered(expected)


def test_dimension_records(release):
    days = release.read_dimension("day_obs").collect()
    assert [(r["id"] * DAY, DAY) for r in days] == [(r["timespan"]["begin_nsec"], r["timespan"]["end_nsec"] - r["timespan"]["begin_nsec"]) for r in days]
    assert sorted(bytes(r["region"]) for r in release.read_dimension("visit_detector_region").collect()) == [bytes([n, 0]) for n in range(4)]


def test_reports(sky, release, spark):
    found = sky.selected()
    of = {n: kind for kind, names in found.items() for n in names}
    counts = {r["dataset_type"]: (r["datasets"], r["datastore_records"], r["associations"]) for r in dataset_counts(release).collect()}
    assert counts == {
        kind: (len(names), sum(n in names for _, n, *_ in sky.records), sum(n in names and c in sky.ORDER for n, c, _ in sky.members))
        for kind, names in found.items()
    }
    assert rows_of(dimension_counts(release), "name", "n_rows") == [("day_obs", 5), ("instrument", 2), ("visit_detector_region", 4)]
    files = {sky.path(s, p).split("#")[0] for s, n, p, _ in sky.records if n in of}
    listing = spark.createDataFrame([(f, 1000) for f in [*files, "gs://unused"]], "file string, size long")
    summary = {r["dataset_type"]: r for r in summarize(release, ["flux", "void"], listing).collect()}
    own = [(sky.path(s, p).split("#")[0], z) for s, n, p, z in sky.records if of.get(n) == "flux"]
    expected = sum(z or 0 for _, z in own) + 1000 * len({f for f, z in own if z is None})
    assert (summary["flux"]["files"], summary["flux"]["bytes"]) == (len({f for f, _ in own}), expected)
    assert (summary["void"]["datasets"], summary["void"]["size"]) == (0, "0 bytes")
    text = summary_text(summarize(release, ["void"]))
    assert "| void | 0 | 0 | 0 bytes | 0 | 0 |" in text.splitlines()
    path = staging_path(spark, "summary.txt")
    write_summary(summarize(release, ["void"]), path, "The release")
    assert spark.read.text(path).first()["value"] == "The release"


def test_transfer_plan(sky, release, spark):
    mapping = {"file:///f": "second", "file:///": "first", "gs://": "third"}
    names = [n for kind in ("flux", "mask") for n in sky.selected()[kind]]
    files = {sky.path(s, p).split("#")[0] for s, n, p, _ in sky.records if n in names}
    pairs = set()
    for file in files:
        store, rest = next((name, file[len(prefix) :].lstrip("/")) for prefix, name in mapping.items() if file.startswith(prefix))
        pairs.add((file.removeprefix("file://"), f"{store}/{rest}"))
    sent = sorted(pairs)[::3]
    listing = spark.createDataFrame([(d,) for _, d in sent], "destination string")
    plan = transfer_plan(release, mapping, ["flux", "m*"], listing, size=7).collect()
    assert {(r["source"], r["destination"]) for r in plan} == pairs - set(sent)
    assert [r["batch"] for r in sorted(plan, key=lambda r: r["source"].encode())] == [n // 7 for n in range(len(plan))]
    with pytest.raises(ReleaseCheckError, match="prefixes"):
        transfer_plan(release, {"file:///f": "second"})


def test_manifest_and_scans(sky, release, spark):
    listed = sorted(sky.TYPES, key=lambda n: (n == "log", n))
    assert [r["name"] for r in release.types] == listed
    assert [r["name"] for r in release.select(["[mv]*", "log"]).types] == ["mask", "void", "log"]
    with pytest.raises(UnmatchedPatternError, match="comet"):
        _ = release.select(["comet*"]).types
    with pytest.raises(KeyError):
        release.read_datasets("comet")
    with pytest.raises(KeyError):
        release.read_dimension("skymap")
    assert manifest_files(release.manifest).count() == len(release.all_paths()) == 1 + 3 + 3 * len(listed)
    assert release.header["dimension_config"] == "kinds: 3\n"
    union = release.read_all_datasets()
    assert set(union.columns) == {"dataset_id", "run", "instrument", "visit", "detector", "dataset_type"}
    assert union.where("dataset_type = 'mask' AND visit IS NOT NULL").count() == 0
    sizes = list_files(spark, release.directory, "*.parquet")
    assert sizes.where("size > 0").count() > 10


def test_listed_files_are_the_records_files(spark, tmp_path):
    (tmp_path / "one.dat").write_bytes(b"x" * 50)
    records = spark.createDataFrame([(f"file://{tmp_path}/one.dat",)], "file string")
    assert [r["size"] for r in fill_sizes(records, list_files(spark, str(tmp_path))).collect()] == [50]


def test_file_names_cannot_leave_the_release(spark, release):
    for name in ("../x.parquet", "a/../../x", "/etc/passwd", ".."):
        with pytest.raises(ValueError, match="outside"):
            release.path_of(name)
    directory = staging_path(spark, "bad")
    fs.make_directory(spark, directory)
    fs.write_text(spark, f"{directory}/manifest.json", '{"collection_export_file": "../c.parquet", "dimension_config": "", "dimension_record_files": {}, "datasets": []}')
    bad = Release(spark, directory)
    assert [r["file"] for r in bad.outside_files().collect()] == ["../c.parquet"]
    assert bad.read_all_datasets().columns == ["dataset_id", "run", "dataset_type"] and bad.read_all_datastore().count() == 0
    with pytest.raises(ReleaseCheckError, match="outside"):
        check_release(bad)


def test_load(sky, release, spark):
    check_release(release)
    mapping = {"file:///": "disk", "gs://": "cloud"}
    target = staging_path(spark, "target")
    paths = load_release(release, target, alias=("deep", "short"), datastore_transform=lambda r: map_to_datastores(r, mapping))
    found = sky.selected()
    steps = {r["dataset_type"]: r for r in fold_progress(spark.read.parquet(paths["progress/datasets"])).collect()}
    assert (steps["flux"]["total"], steps["flux"]["imported"], steps["flux"]["status"]) == (len(found["flux"]),) * 2 + ("complete",)
    loaded = spark.read.parquet(paths["datasets"])
    assert rows_of(loaded, "dataset_id", "dataset_type") == ordered((key(n), kind) for kind, names in found.items() for n in names)
    of = {n for names in found.values() for n in names}
    expected = []
    for store, name, path, _ in sky.records:
        if name in of:
            uri = sky.path(store, path)
            expected.append((key(name), "cloud" if uri.startswith("gs") else "disk", uri.split("://", 1)[1].lstrip("/")))
    assert rows_of(spark.read.parquet(paths["datastore"]), "dataset_id", "datastore_name", "path") == ordered(expected)
    links = {**sky.CHAINS, "short": sky.CHAINS["deep"]}
    assert rows_of(spark.read.parquet(paths["collection_chain"]), "parent", "position", "child") == ordered(
        (parent, place, child) for parent, children in links.items() for place, child in enumerate(children)
    )
    entries = [(c, key(n)) for n, c, _ in sky.members if n in of and c in sky.ORDER]
    assert rows_of(spark.read.parquet(paths["tags"]), "collection", "dataset_id") == ordered(e for e in entries if e[0][0] == "p")
    assert rows_of(spark.read.parquet(paths["calibrations"]), "collection", "dataset_id") == ordered(e for e in entries if e[0][0] == "b")
    with pytest.raises(Exception, match="(?i)exists"):
        load_release(release, target, check=False)
    with pytest.raises(MissingCollectionError):
        load_release(release, staging_path(spark, "absent"), check=False, alias=("none", "short"))


def test_a_load_goes_on_where_it_was_cut(sky, spark, catalog, monkeypatch):
    """Every call finishes what was begun and is cut before the note of the next of some new tables."""
    cuts = ["dataset_types", "dimensions/day_obs", "collections", "datasets", "progress/datasets", "datastore", "tags"]
    release = export_release(catalog, staging_path(spark, "resumed"), ["mask", "bi*"], [], ["survey"])
    target, written, run = staging_path(spark, "pieces"), [], Steps.run

    class Cut(Exception):
        pass

    def cut_once(self, name, job):
        if name not in cuts or self._noted(name, "begun"):
            return run(self, name, lambda path: (written.append(name), job(path)))

        def half(path):
            job(path)
            written.append(name)
            raise Cut(name)

        return run(self, name, half)

    monkeypatch.setattr(Steps, "run", cut_once)
    for calls in range(1, 60):
        try:
            paths = load_release(release, target, check=False)
        except Cut:
            continue
        break
    # Two of them are of one step.
    assert calls == len(cuts) and set(written) == set(paths)
    # Cut once and finished once, and never written again.
    assert all(written.count(name) == 1 + (name in cuts) for name in paths)
    monkeypatch.setattr(Steps, "run", run)
    before = len(written)
    assert load_release(release, target, check=False) == paths and len(written) == before
    whole = load_release(release, staging_path(spark, "whole"), check=False)
    for name in paths:
        a, b = (spark.read.parquet(p[name]) for p in (paths, whole))
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    folded = {r["dataset_type"]: tuple(r) for r in fold_progress(spark.read.parquet(paths["progress/dimensions/day_obs"])).collect()}
    assert folded == {"dimension day_obs": ("dimension day_obs", 5, 5, "complete")}
    rewrite_table(spark, release.dimension_path("instrument"), lambda df: df.where("name = 'north'"), release.spec.record_schema("instrument"))
    with pytest.raises(FileExistsError, match="another load"):
        load_release(release, target, check=False)


def test_references_are_checked_in_one_pass(sky, spark, catalog):
    release = export_release(catalog, staging_path(spark, "references"), ["flux", "mask"], [], ["survey"])
    assert record_orphans(release).isEmpty() and dataset_orphans(release).isEmpty()
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan")
    # Datasets of two schemas and one table for each dimension a data ID names.
    assert scans(dataset_orphans(release)) <= 2 + len(release.dimension_files)
    rewrite_table(spark, release.dimension_path("instrument"), lambda df: df.where("name = 'south'"), release.spec.record_schema("instrument"))
    found = {(r["dimension"], r["parent"]): int(r["orphans"]) for r in record_orphans(release).collect()}
    assert found == {("day_obs", "instrument"): 5}
    with pytest.raises(ReleaseCheckError, match="parent"):
        check_release(release)


def test_a_load_loses_nothing_silently(release, spark):
    with pytest.raises(ReleaseCheckError, match="without a datastore"):
        load_release(release, staging_path(spark, "half"), check=False, datastore_transform=lambda r: map_to_datastores(r, {"gs://": "cloud"}))
    copy = staging_path(spark, "copy")
    shutil.copytree(release.directory.removeprefix("file:"), copy.removeprefix("file:"))
    changed = Release(spark, copy)
    rename = lambda df: df.withColumn("collection", F.lit("elsewhere"))
    row = changed.type_named("mask")
    rewrite_table(spark, changed.path_of(row["association_export_file"]), rename, changed.spec.association_schema(row["dimensions"]))
    with pytest.raises(ReleaseCheckError, match="no such kind"):
        load_release(changed, staging_path(spark, "odd"), check=False)
    forget = lambda df: df.withColumn("run", F.when(F.col("run") != "run0", F.col("run")))
    rewrite_table(spark, changed.path_of(row["dataset_export_file"]), forget, changed.spec.dataset_schema(row["dimensions"]))
    with pytest.raises(ReleaseCheckError, match="No value"):
        check_release(changed)
    lost = lambda df: df.where("name = 'north'")
    rewrite_table(spark, changed.dimension_path("instrument"), lost, changed.spec.record_schema("instrument"))
    assert {r["dimension"] for r in dataset_orphans(changed).collect()} == {"instrument"}
    rewrite_table(spark, changed.path_of(row["dataset_export_file"]), lambda df: df.limit(0), changed.spec.dataset_schema(row["dimensions"]))
    assert {(r["kind"], r["dataset_type"]) for r in stray_rows(changed).collect()} == {("datastore", "mask"), ("association", "mask")}


def test_checks_stop_a_bad_export(sky, spark, catalog):
    twice = catalog.datasets.where("run = 'run0' AND dataset_type = 'mask'").withColumn("detector", F.lit(99).cast("long"))
    bad = Catalog(**{**catalog.__dict__, "datasets": catalog.datasets.unionByName(twice)})
    with pytest.raises(ReleaseCheckError, match="more than once"):
        check_release(export_release(bad, staging_path(spark, "twice"), ["mask"], [], ["survey"]))
    with pytest.raises(ReleaseCheckError, match="without a root"):
        export_release(Catalog(**{**catalog.__dict__, "roots": {}}), staging_path(spark, "rootless"), ["mask"], [], ["survey"])
    with pytest.raises(UnmatchedPatternError, match="comet"):
        export_release(catalog, staging_path(spark, "absent"), ["comet", "mask"], [], ["survey"])
    assert null_violations(twice.withColumn("run", F.lit(None).cast("string")), STANDARD_SPEC.dataset_schema(["detector"])).collect()[0]["column"] == "run"
    assert schema_differences(twice, STANDARD_SPEC.dataset_schema(["detector"])) == ["unknown dataset_type", "unknown visit"]


def test_an_export_without_any_dataset(sky, spark, catalog):
    release = export_release(catalog, staging_path(spark, "empty"), ["void"], [], ["survey"])
    assert release.read_all_datasets().count() == 0
    assert {r["name"] for r in release.read_collections().collect()} == set(sky.ORDER)
    assert transfer_plan(release, {"file:///": "first"}).count() == 0
    paths = load_release(release, staging_path(spark, "empty_target"))
    assert spark.read.parquet(paths["datasets"]).columns[0] == "dataset_id"
    assert spark.read.parquet(paths["calibrations"]).count() == 0


def test_storage_class_patch(sky, spark, catalog):
    release = export_release(catalog, staging_path(spark, "patched"), ["flux", "mask"], [], ["survey"])
    changed = change_storage_class(release, ["mask", "void"], "Table")
    assert {r["name"]: r["storageClass"] for r in changed.types} == {"flux": "Frame", "mask": "Table"}
    assert changed.read_datasets("flux").count() == len(sky.selected()["flux"])


def test_files_with_uuid_dictionary_and_time_span_columns(spark, tmp_path):
    """A table as another program writes it: one file, UUID type, dictionary strings, a struct of nanoseconds."""
    span = pa.struct([("begin_nsec", pa.int64()), ("end_nsec", pa.int64())])
    text = pa.dictionary(pa.int32(), pa.string())
    table = pa.table(
        {
            "dataset_id": pa.array([key("one")], pa.uuid()),
            "run": pa.array(["runs/a"], text),
            "instrument": pa.array(["cam"], text),
            "visit": pa.array([7], pa.int64()),
            "collection": pa.array(["tag"], text),
            "timespan": pa.array([{"begin_nsec": 1, "end_nsec": 2}], span),
        }
    )
    pq.write_table(table, tmp_path / "t1.association.parquet", compression="zstd")
    pq.write_table(table.select(range(4)), tmp_path / "t1.datasets.parquet", compression="zstd")
    (tmp_path / "manifest.json").write_text(
        '{"collection_export_file": "c.parquet", "dimension_config": "", "dimension_record_files": {}, "datasets": ['
        '{"dataset_type": {"name": "t1", "storageClass": "int", "dimensions": ["instrument", "visit"], '
        '"parentStorageClass": null, "isCalibration": false}, "dataset_export_file": "t1.datasets.parquet", '
        '"datastore_export_file": "t1.datastore.parquet", "association_export_file": "t1.association.parquet"}]}'
    )
    release = Release(spark, str(tmp_path))
    row = release.read_associations("t1").first()
    assert (bytes(row["dataset_id"]), row["collection"], row["timespan"]["end_nsec"]) == (key("one"), "tag", 2)
    ids = release.read_datasets("t1").select(binary_to_hex("dataset_id").alias("id"))
    assert ids.first()["id"] == key("one").hex()
