"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .schemas import as_nullable

# Runtime settings the operators rely on.  All of them can be changed on a live
# session, so ``configure`` also works on a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffled keys and ids are small when compressed: what one task reads is bounded, whatever the number of cores, and
    # a side that fits in that is hashed instead of sorted.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
    # Chains nest as deep as they like: a walk ends where a name repeats.
    "spark.sql.cteRecursionLevelLimit": "-1",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# How many files a task may write at the same time.
FEW = 8


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a running session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "releasecat", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session with the settings of this package.

    ``conf`` keys use ``__`` in place of ``.``:
    ``build_session(spark__sql__shuffle__partitions="8")``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    It is the cluster's ``spark.checkpoint.dir``.  Only a local session, as in
    tests, falls back to a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is not None:
        return current
    # The executors of local-cluster are processes of their own.
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="releasecat-"))
    return context.getCheckpointDir()


def staging_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stored", *partition_by: str) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    They are computed once, whatever happens to executors, and the size of the
    written table is what Spark plans the next joins with.  A partitioned table
    is rebalanced first: a file for each task and partition would be too many.
    """
    path = staging_path(df.sparkSession, label)
    if partition_by:
        spread = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        spread = df.write
    spread.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(as_nullable(df.schema)).parquet(path)


@contextmanager
def side_by_side(spark: SparkSession, values: int) -> Iterator[None]:
    """Inside, a task of a partitioned write has a file open for each of ``values`` values, at most ``FEW``, and does not
    sort its rows by them first.  No write inside may have more: what is above the limit is sorted and loses its order."""
    if values > FEW:
        yield
        return
    before = spark.conf.get(WRITERS)
    # Spark starts to sort when the limit is reached.
    spark.conf.set(WRITERS, str(values + 1))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def run_together(jobs: Iterable[Callable[[], object]], limit: int = 8) -> list:
    """Run independent jobs at the same time, so that small ones do not wait for each other; their results in order."""
    with ThreadPoolExecutor(limit) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]
