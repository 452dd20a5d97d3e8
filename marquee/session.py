"""Session set-up: runtime options and the checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the options every operator counts on; safe to call again on a live session."""
    for key, value in RUNTIME_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# What one task should take out of a shuffle.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions to start a shuffle of this size with; adaptive execution joins those that stay small."""
    return max(200, ceil(shuffled_bytes / SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str = "marquee", master: str | None = None, shuffled_bytes: int | None = None, **options: str
) -> SparkSession:
    """A configured session. On a cluster leave ``master`` out: spark-submit names it.

    ``shuffled_bytes`` is the size of the largest table that a job shuffles.
    """
    builder = SparkSession.builder.appName(app_name)
    if shuffled_bytes:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_partitions(shuffled_bytes))
        )
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def use_checkpoints(spark: SparkSession) -> None:
    """Point the context at the shared folder named by ``spark.checkpoint.dir``.

    A temporary folder serves only in local mode, where one machine holds everything.
    A cluster without the setting is an error: a folder on the driver's own disk would
    be out of the executors' reach.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="marquee-checkpoint-")
    context.setCheckpointDir(folder)


# Folders in the checkpoint folder that this process has named.
_NAMED: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the checkpoint folder, which all executors share."""
    use_checkpoints(spark)
    _NAMED.append(f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}")
    return _NAMED[-1]


def is_kept(path: str | None) -> bool:
    """Whether this process has named the folder and not deleted it since."""
    return path in _NAMED


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is stored."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def remove_stored(df: DataFrame) -> None:
    """Delete the tables that ``store_once`` wrote for a frame; nothing made from it can be computed any more."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        remove_folder(df.sparkSession, path)


def forget_stored(spark: SparkSession) -> None:
    """Delete what this process put into the checkpoint folder; call it when no frame made from it is needed any more."""
    while _NAMED:
        remove_folder(spark, _NAMED.pop())


# Up to which size, per partition, the smaller side of a shuffled join is a hash table instead of both sides being sorted.
HASH_JOINS = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


@contextmanager
def runtime_option(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Another value of an option for the work done inside the block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Whether a query's shuffle files are deleted when it ends, and not when the driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store_once(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed now and read back from a table in the checkpoint folder.

    For results that are used several times: later stages do not repeat the work, a lost
    executor takes nothing with it, and every reader sees the same partitions. The shuffle
    files of the work are deleted once the table is there.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with runtime_option(spark, FREE_SHUFFLES, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
