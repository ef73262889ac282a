"""Session settings the jobs expect, and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .sources.paths import remove_folder

# Runtime settings: safe to set on a session that already exists.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffled bytes are packed: grouped, sorted and joined, 62 MB of them took 1 GB of a task's memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
#: While it holds, an action removes its shuffle files when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session.

    ``input_bytes``, the size of what a job reads, sets how many shuffle partitions
    AQE starts from: enough that one fits into a task's memory even if nothing is
    filtered. AQE merges the small ones, up to the same size.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        start = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // SHUFFLE_PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_PARTITION_BYTES))
    return spark


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tideline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's checkpoint folder, ``spark.checkpoint.dir``.

    A session of one machine without that setting gets a folder of its own, once. On a
    cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What an action inside shuffles leaves the disks when the action ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Frames that are :func:`materialized` inside leave the shared folder at the end; none may be read later."""
    folders: list[str] = []
    token = _SCRATCH.set(folders)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For frames that are expensive and read more than once: later passes read only
    the columns they need, and a lost executor repeats no earlier work. What was
    shuffled for it leaves the disks once it is written.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, name)
    folders = _SCRATCH.get()
    if folders is not None:
        folders.append(folder)
    with shuffles_removed(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
