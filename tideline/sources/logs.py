"""Append-only logs: entries are added, never changed, so writers do not overwrite each other.

Each entry is a folder of its own with a row or a few, and counts once Spark has committed
its write. Writing an entry again under the same name leaves one entry. State is what an
aggregation over the entries says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp
from .paths import subfolders


class AppendLog:
    """Rows of ``schema`` by entry; the column ``entry`` names the entry."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def add(self, entry: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/entry={entry}")

    def read(self) -> DataFrame:
        schema = f"{self.schema}, entry string"
        if not subfolders(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)


def _entry(*parts: object) -> str:
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


class OffsetLog:
    """Offsets of jobs, one entry per job and batch; the entry added last counts."""

    SCHEMA = "sql_folder_name string, batch string, written_at timestamp, last_offset string, number bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.log = AppendLog(spark, path, self.SCHEMA)

    def _of(self, name: str) -> DataFrame:
        return self.log.read().filter(F.col("sql_folder_name") == name)

    def record(self, name: str, batch: object, offset: object, now) -> None:
        """Adds the offset behind a batch. Repeating a batch replaces its own entry alone."""
        entry = _entry(name, batch)
        number = self._of(name).filter(F.col("entry") != entry).agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        row = self.spark.range(1).select(
            F.lit(name).alias("sql_folder_name"), F.lit(str(batch)).alias("batch"), as_timestamp(now).alias("written_at"),
            F.lit(None if offset is None else str(offset)).cast("string").alias("last_offset"), F.lit(number).cast("bigint").alias("number"),
        )
        self.log.add(entry, row)

    def holds(self, name: str, batch: object) -> bool:
        return not self._of(name).filter(F.col("batch") == str(batch)).isEmpty()

    def last(self, name: str, default=None) -> str | None:
        """The offset added last; the default for a job without one."""
        found = self._of(name).agg(F.max_by("last_offset", F.struct("number", "entry"))).first()[0]
        return default if found is None else found

    def state(self) -> DataFrame:
        """One row per job: when its first and its last entry were added, and the last offset."""
        return self.log.read().groupBy("sql_folder_name").agg(
            F.min("written_at").alias(fv.OFFSET_COLUMNS[1][0]),
            F.max("written_at").alias(fv.OFFSET_COLUMNS[2][0]),
            F.max_by("last_offset", F.struct("number", "entry")).alias(fv.OFFSET_COLUMNS[3][0]),
        )

    def once(self, name: str, sink: Callable[[DataFrame, int], object], now) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` sink that skips the batches already logged; what ``sink`` returns is logged as the offset.

        The log is written after the sink, so a batch that dies in between comes again:
        the sink must replace what it wrote.
        """

        def guarded(batch: DataFrame, batch_id: int) -> None:
            if not self.holds(name, batch_id):
                self.record(name, batch_id, sink(batch, batch_id), now)

        return guarded
