"""Load of a release into tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..functions.identifiers import or_unbounded
from ..operators.collections import add_alias_chain, chain_edges, collection_nodes
from ..operators.joins import keep_missing, orphans, shuffled
from ..operators.progress import load_events
from ..operators.validation import (
    ReleaseCheckError,
    bad_association_collections,
    duplicate_ids,
    null_violations,
    require_none,
    schema_differences,
)
from ..schemas import CALIBRATION, COLLECTIONS, DATASTORE, TAGGED, as_nullable, by_dimensions
from ..session import run_together
from ..sinks.rewrite import recover_release
from ..sinks.tables import write_empty
from ..sources.release import Release

DatastoreTransform = Callable[[DataFrame], DataFrame]


def reference_report(release: Release, dimension: str) -> DataFrame:
    """Number of records of one element that refer to a missing record, for each table referred to."""
    child = release.read_dimension(dimension)
    counts = []
    for parent, columns in release.spec.references(dimension):
        if parent in release.dimension_files:
            missing = orphans(child, release.read_dimension(parent), columns)
            counts.append(missing.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(parent).alias("parent"), "orphans"))
    if not counts:
        return release.spark.createDataFrame([], "parent string, orphans long")
    return reduce(DataFrame.unionByName, counts)


def _key(df: DataFrame, columns: Iterable[str]) -> Column:
    """Key columns of any types as one value that joins with equality; NULL if one of them is."""
    values = [df[c].cast("string") for c in columns]
    return F.when(reduce(Column.__and__, [v.isNotNull() for v in values]), F.array(*values))


def _missing_keys(named: DataFrame, known: Iterable[DataFrame]) -> DataFrame:
    """Rows of ``named`` whose ``element`` and ``key`` no table of ``known`` holds: one anti-join for all elements."""
    held = shuffled(reduce(DataFrame.unionByName, known))
    return keep_missing(named, held, {"element": "element", "key": "key"}, unique_keys=True)


def dataset_orphans(release: Release) -> DataFrame:
    """Data IDs of datasets without a record of the dimension they name: ``dataset_type, dimension, orphans``.

    The datasets are read once: each row gives a key for every stored dimension it names, different keys of a type are
    kept once, and one anti-join looks for all of them among the keys of all dimensions.
    """
    datasets = release.read_all_datasets()
    keys = {name: release.spec.dataset_keys(name) for name in release.dimension_files}
    keys = {name: own for name, own in keys.items() if own and set(own) <= set(datasets.columns)}
    if not keys:
        return release.spark.createDataFrame([], "dataset_type string, dimension string, orphans long")
    pairs = F.array(*[F.struct(F.lit(n).alias("element"), _key(datasets, own).alias("key")) for n, own in keys.items()])
    named = datasets.select("dataset_type", F.inline(pairs)).where(F.col("key").isNotNull()).distinct()
    tables = {name: release.read_dimension(name) for name in keys}
    known = [df.select(F.lit(n).alias("element"), _key(df, keys[n].values()).alias("key")) for n, df in tables.items()]
    missing = _missing_keys(named, known)
    return missing.groupBy("dataset_type", F.col("element").alias("dimension")).agg(F.count(F.lit(1)).alias("orphans"))


def record_orphans(release: Release) -> DataFrame:
    """Records that refer to a missing record, of all elements in one pass: ``dimension, parent, orphans``.

    Each record gives a key for every table it refers to; equal keys are counted before they are looked for.
    """
    known, wanted = {}, []
    for name in release.dimension_files:
        child = release.read_dimension(name)
        for parent, columns in release.spec.references(name):
            if parent not in release.dimension_files:
                continue
            element = f"{parent} {sorted(columns.values())}"
            order = sorted(columns, key=columns.get)
            table = release.read_dimension(parent)
            known[element] = table.select(F.lit(element).alias("element"), _key(table, sorted(columns.values())).alias("key"))
            wanted.append(
                child.select(
                    F.lit(name).alias("dimension"), F.lit(parent).alias("parent"), F.lit(element).alias("element"), _key(child, order).alias("key")
                )
            )
    if not wanted:
        return release.spark.createDataFrame([], "dimension string, parent string, orphans long")
    rows = reduce(DataFrame.unionByName, wanted).where(F.col("key").isNotNull())
    counted = rows.groupBy("dimension", "parent", "element", "key").agg(F.count(F.lit(1)).alias("n"))
    # Keys that elements refer to need not identify a record there, so equal ones are made one.
    missing = _missing_keys(counted, [table.distinct() for table in known.values()])
    return missing.groupBy("dimension", "parent").agg(F.sum("n").alias("orphans"))


def stray_rows(release: Release) -> DataFrame:
    """File records and association entries without a dataset: ``kind, dataset_type, orphans``; one anti-join for both."""
    keys = {"dataset_type": "dataset_type", "dataset_id": "dataset_id"}
    ids = release.read_all_datasets().select(*keys)
    kinds = {"datastore": release.read_all_datastore(), "association": release.read_all_associations()}
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("kind"), *keys) for kind, df in kinds.items()])
    missing = keep_missing(rows, shuffled(ids), keys, unique_keys=True)
    return missing.groupBy("kind", "dataset_type").agg(F.count(F.lit(1)).alias("orphans"))


def null_report(release: Release) -> DataFrame:
    """NULLs in required columns of the dump's tables: ``table, column, nulls``."""
    tables = {
        **{f"dimension {n}": (release.read_dimension(n), release.spec.record_schema(n)) for n in release.dimension_files},
        "collections": (release.read_collections(), COLLECTIONS),
        "datastore": (release.read_all_datastore(), DATASTORE),
    }
    for dimensions, names in by_dimensions(release.types).items():
        schema = release.spec.dataset_schema(dimensions)
        entries = release.spec.association_schema(dimensions)
        tables[f"datasets {names}"] = (release.read_all_datasets(names), schema)
        tables[f"associations {names}"] = (release.read_all_associations(names), entries)
    reports = [
        null_violations(df, schema).select(F.lit(name).alias("table"), "column", "nulls")
        for name, (df, schema) in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def check_release(release: Release, references: bool = True) -> None:
    """Raise at the first kind of violation.  Every check is an action of its own."""
    require_none(release.outside_files(), "Files outside the release directory")
    recover_release(release)
    require_none(null_report(release), "No value in required columns")
    datasets = release.read_all_datasets()
    require_none(duplicate_ids(datasets, "dataset_id"), "Dataset ids used more than once")
    require_none(
        bad_association_collections(release.read_all_associations(), release.read_collections()),
        "Associations with a collection of no such kind",
    )
    require_none(
        keep_missing(
            datasets.select("run").distinct(), release.read_collections(), {"run": "name"}, unique_keys=True
        ),
        "Datasets in runs that are not in the release",
    )
    for name in release.dimension_files:
        raw = release.spark.read.parquet(release.dimension_path(name))
        problems = schema_differences(raw, as_nullable(release.spec.record_schema(name)))
        if problems:
            raise ReleaseCheckError(f"Records of {name} do not fit: {problems}")
    if references:
        require_none(record_orphans(release), "Records without a parent")
        require_none(dataset_orphans(release), "Datasets without a dimension record")
        require_none(stray_rows(release), "Rows that belong to no dataset")


class Steps:
    """Steps of a load into a folder, so that a load that was cut short can be called again.

    A step is noted before and after its table is written, with the fingerprint of what is loaded.  A finished step is
    skipped, the table of one that was only begun is removed and written again.  Anything else in the way, a table
    that no step of this load has begun or the notes of another load, is an error.
    """

    def __init__(self, spark: SparkSession, target: str, fingerprint: str):
        self.spark, self.target, self.fingerprint = spark, target, fingerprint

    def note(self, name: str, state: str) -> str:
        return f"{self.target}/_steps/{name.replace('/', '.')}.{state}"

    def _noted(self, name: str, state: str) -> bool:
        path = self.note(name, state)
        if not fs.exists(self.spark, path):
            return False
        if fs.read_text(self.spark, path) != self.fingerprint:
            raise FileExistsError(f"{self.target} exists and holds {name} of another load")
        return True

    def run(self, name: str, job: Callable[[str], None]) -> str:
        """Path of the step's table, after ``job`` has written it or an earlier call has."""
        path = f"{self.target}/{name}"
        begun = self._noted(name, "begun")
        if not self._noted(name, "done"):
            if fs.exists(self.spark, path):
                if not begun:
                    raise FileExistsError(path)
                fs.delete(self.spark, path)
            fs.write_text(self.spark, self.note(name, "begun"), self.fingerprint)
            job(path)
            fs.write_text(self.spark, self.note(name, "done"), self.fingerprint)
        return path


def load_fingerprint(release: Release, *choices: object) -> str:
    """Hash of the manifest, of lengths and times of all files of the dump, and of what was chosen to be loaded."""
    files = [(path, *fs.length_and_time(release.spark, path)) for path in sorted(release.all_paths())]
    header = release.manifest.select(F.to_json(F.struct("*"))).first()[0]
    return hashlib.sha256(repr((header, files, [t["name"] for t in release.types], choices)).encode()).hexdigest()


def load_release(
    release: Release,
    target: str,
    globs: Iterable[str] | None = None,
    datastore_transform: DatastoreTransform | None = None,
    check: bool = True,
    references: bool = True,
    alias: tuple[str, str] | None = None,
) -> dict[str, str]:
    """Load a dump into new Parquet tables under ``target``; returns their paths.

    Order: dataset types, dimension records after the records they refer to,
    collections and then their links, datasets, and last what refers to
    datasets.  Tables of one step are written at the same time.  They are new,
    so nothing is looked up while they are written.  ``alias`` (existing chain,
    new name) adds a chain.  The progress tables hold the events of each step.

    A load that was cut short goes on where it ended when it is called again
    with the same dump and choices, see ``Steps``; a transform is told by its
    name.
    """
    spark = release.spark
    chosen = release.select(globs)
    # Swaps that a rewrite left open are finished first: they change what is fingerprinted.
    require_none(release.outside_files(), "Files outside the release directory")
    recover_release(release)
    transform = getattr(datastore_transform, "__qualname__", repr(datastore_transform)) if datastore_transform else None
    steps = Steps(spark, target, load_fingerprint(chosen, transform, check, references, alias))
    if check:
        steps.run("_checked", lambda _: check_release(chosen, references))
    paths: dict[str, str] = {}

    def write(**tables: DataFrame) -> None:
        named = {key.replace("__", "/"): df for key, df in tables.items()}
        paths.update({name: f"{target}/{name}" for name in named})
        run_together([partial(steps.run, name, partial(_write_loaded, df)) for name, df in named.items()])

    def report(step: str, kind: str | None = None) -> None:
        """Events of a step by dataset type, or of a table that has none under the name ``kind``."""
        written = spark.read.parquet(paths[step])
        counts = written.groupBy("dataset_type" if kind is None else F.lit(kind).alias("dataset_type"))
        counts = counts.agg(F.count(F.lit(1)).alias("n_rows"))
        if kind is not None:
            none = spark.createDataFrame([(kind, 0)], "dataset_type string, n_rows long")
            counts = counts.union(none).groupBy("dataset_type").agg(F.sum("n_rows").alias("n_rows"))
        events = load_events(counts).coalesce(1)
        paths[f"progress/{step}"] = steps.run(f"progress/{step}", lambda path: events.write.parquet(path))

    write(dataset_types=chosen.type_table.drop("position"))
    for stage in release.spec.load_order(list(release.dimension_files)):
        write(**{f"dimensions__{name}": release.read_dimension(name) for name in stage})
        run_together([partial(report, f"dimensions/{name}", f"dimension {name}") for name in stage])
    collections = release.read_collections()
    if alias is not None:
        collections = add_alias_chain(collections, *alias)
    write(collections=collection_nodes(collections))
    write(collection_chain=chain_edges(collections))
    report("collections", "collections")
    write(datasets=chosen.read_all_datasets())
    report("datasets")

    records = chosen.read_all_datastore()
    if datastore_transform is not None:
        records = records.transform(datastore_transform)
    entries = chosen.read_all_associations()
    # Checked in any case: the split below would leave these entries out.
    require_none(bad_association_collections(entries, collections), "Associations with a collection of no such kind")
    tagged, calibrations = split_associations(entries, collections)
    write(
        datastore=records.select(*DATASTORE.names, "dataset_type"),
        tags=tagged,
        calibrations=calibrations,
    )
    require_none(
        spark.read.parquet(paths["datastore"]).where("datastore_name IS NULL OR path IS NULL").select("dataset_type", "dataset_id"),
        "File records that the transform left without a datastore or a path",
    )
    for step in ("datastore", "tags", "calibrations"):
        report(step)
    return paths


def _write_loaded(df: DataFrame, path: str) -> None:
    # One type can hold a third of the rows: rebalancing cuts it and joins small ones.
    by = [c for c in ("dataset_type",) if c in df.columns]
    writer = df.hint("rebalance", *by).write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    if by and not any(name.startswith("dataset_type=") for name in fs.list_names(df.sparkSession, path)):
        # Without rows there is no partition, and without a file nobody could tell the columns.
        write_empty(df.sparkSession, path, df.schema, mode="append")


def split_associations(associations: DataFrame, collections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of tagged collections, and of calibration collections with their time span."""
    kinds = collections.select(F.col("name").alias("collection"), F.col("type").alias("__type"))
    typed = associations.join(kinds, "collection")
    tagged = typed.where(F.col("__type") == TAGGED).select("dataset_type", "collection", "dataset_id")
    calibrations = typed.where(F.col("__type") == CALIBRATION).select(
        "dataset_type", "collection", "dataset_id", or_unbounded("timespan").alias("timespan")
    )
    return tagged, calibrations
