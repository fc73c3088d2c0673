"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here wants. A value set by the operator of the cluster wins.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The sales joins stack on one key, and there AQE splits a hot key only if it may add
    # a shuffle above the split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Also the target size of written files. Compressed: a task that joins, groups and sorts the rows of a
    # fact was seen to hold 25 times as much.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

SHUFFLE_BYTES_PER_TASK = 32 * 1024 * 1024
SHUFFLED_OF_STORED = 8  # bytes that the rows of a fact take in a shuffle, for one of the columnar files they come from
COMPRESSION = "zstd"  # of the files of tables and of rows to be numbered; those of facts were 16 to 46 % smaller than by default
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings above where the session was started without them.

    ``shuffle_bytes``, the size of the largest shuffle expected, raises the number of partitions that
    shuffles start with, so that one fits the memory of a task; AQE merges those that turn out small.
    Streams, which AQE does not plan, keep the number that the session was given.
    """
    started_with = {k for k, _ in spark.sparkContext.getConf().getAll()}
    # Listing the folders of a table by one task each costs more than the listing.
    listing_tasks = str(4 * spark.sparkContext.defaultParallelism)
    settings = {**RUNTIME_SETTINGS, "spark.sql.sources.parallelPartitionDiscovery.parallelism": listing_tasks}
    for name, value in settings.items():
        if name not in started_with:
            spark.conf.set(name, value)
    if shuffle_bytes:
        wanted = -(-shuffle_bytes // SHUFFLE_BYTES_PER_TASK)
        if wanted > shuffle_partitions(spark):
            spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions that shuffles start with."""
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one named in ``spark.checkpoint.dir``.

    The folders of a run lie together under its application id, so that they can be removed
    once its results are written. Only a local session without the setting gets a folder of
    this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back. Without ``compression`` files have the session's.

    Readers after it see a columnar scan: what lies above is not computed again, neither by
    a second use nor when an executor is lost.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SIDE_BY_SIDE = 4  # jobs at once: enough that the last tasks of one leave no core idle


def side_by_side(steps: list[Callable[[], object]], most: int = SIDE_BY_SIDE) -> list:
    """The results of steps that run jobs and do not build on each other, in their order.

    The driver submits up to ``most`` at a time; tasks are as many at once as without it. If steps fail, the
    first one's error is raised once none runs any more.
    """
    spark = SparkSession.getActiveSession()
    pinned = inheritable_thread_target(spark)  # of no use, and the session itself, if threads are not pinned
    with ThreadPoolExecutor(most) as threads:
        running = [threads.submit(step if pinned is spark else pinned(step)) for step in steps]
    return [step.result() for step in running]
