"""Writers of tables: staged exports, text exports, tables of day folders, day replacement."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed_values as fv
from ..operators.checks import require_rows, write_checked
from ..operators.intervals import folder_names
from .logs import AppendLog
from .paths import remove_folder, subfolders

#: Folders of a day table, and the name Spark gives to the folder of rows without a day.
_LOAD, _DAY, _NO_DAY = "load_id", "load_day", "__HIVE_DEFAULT_PARTITION__"


def staged_export(df: DataFrame, path: str, batch_start, max_records_per_file: int = 1_000_000) -> None:
    """Write a batch to ``path/date=…/time=…``, replacing just that folder."""
    date, time = folder_names(batch_start)
    (
        df.withColumns({"date": date, "time": time})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("date", "time")
        .parquet(path)
    )


def pipe_export(df: DataFrame, path: str) -> None:
    """Full export as pipe-delimited text without header, replacing the last one."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    (
        texts.write.mode("overwrite")
        .option("sep", "|")
        .option("quote", "\"")
        .option("escape", "\"")
        .option("emptyValue", "")
        .option("maxRecordsPerFile", 1_000_000)
        .csv(path)
    )


def chunked_csv(df: DataFrame, path: str, rows_per_file: int = fv.ROWS_PER_FILE) -> None:
    """Gzip CSV files with header, of at most ``rows_per_file`` rows; no rows is an error."""
    require_rows(df, "nothing to stage")
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


class DayTable:
    """A table in day folders, changed by loads that count once they are logged.

    A load writes its batch to folders of its own and then adds one entry to the table's
    log: which days it holds and which it replaces. A reader takes each day from the last
    load that covers it, so it never sees a part of a load, untouched days keep their
    files, and a load that dies changes nothing. Days in a load are those of ``key``, a
    date; rows without a day are only added, unless a load replaces all.
    """

    LOG = "number bigint, days array<string>, replaces string, columns string"

    def __init__(self, spark: SparkSession, path: str, key: str, schema=None):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema
        self.log = AppendLog(spark, f"{self.path}/log", self.LOG)

    def replace(
        self,
        batch: DataFrame,
        replaces: str = "days",
        forbidden: Mapping[str, Column] | None = None,
        accept: Callable[[list[str]], None] | None = None,
    ) -> None:
        """Adds the batch and drops the rows it replaces: those of its ``days``, all ``from`` its first day on, or ``all``.

        A batch without days changes nothing unless it replaces all. Rows that are
        ``forbidden``, as in :func:`write_checked`, are counted while the batch is written,
        and a batch with any fails and does not count. ``accept`` is given the days that
        were written; where it raises, the load does not count either.
        """
        load = uuid.uuid4().hex
        days = batch.withColumn(_DAY, F.col(self.key).cast("date").cast("string"))
        folder = f"{self.path}/rows/{_LOAD}={load}"
        write_checked(days, lambda rows: rows.write.partitionBy(_DAY).parquet(folder), forbidden or {})
        held = [name.partition("=")[2] for name in subfolders(self.spark, f"{self.path}/rows/{_LOAD}={load}")]
        if accept is not None:
            accept([day for day in held if day != _NO_DAY])
        number = self.log.read().agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        row = (number, held, replaces, batch.schema.json())
        self.log.add(load, self.spark.createDataFrame([row], self.LOG))

    def loads(self) -> list:
        """The log, a row per load."""
        return self.log.read().orderBy("number", "entry").collect()

    def _live(self) -> list[tuple[str, str]]:
        """(load, day) of the folders that count."""
        live: list[tuple[str, str]] = []
        for row in self.loads():
            days = [d for d in row["days"] if d != _NO_DAY]
            if row["replaces"] == "all":
                live = []
            elif row["replaces"] == "from" and days:
                live = [x for x in live if x[1] == _NO_DAY or x[1] < min(days)]
            else:
                live = [x for x in live if x[1] == _NO_DAY or x[1] not in days]
            live += [(row["entry"], day) for day in row["days"]]
        return live

    def read(self) -> DataFrame:
        """The table's rows; only folders that count are listed and read."""
        loads = self.loads()
        if not loads and self.schema is None:
            raise FileNotFoundError(f"no load below {self.path}")
        schema = StructType.fromJson(json.loads(loads[-1]["columns"])) if loads else self.schema
        live = self._live()
        if not live:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/rows/{_LOAD}={load}/{_DAY}={day}" for load, day in live]
        return self.spark.read.schema(schema).parquet(*folders)

    def vacuum(self) -> int:
        """Removes the folders that do not count, also those of loads that died. No load or reader may run meanwhile."""
        live, removed = set(self._live()), 0
        for load in subfolders(self.spark, f"{self.path}/rows"):
            for day in subfolders(self.spark, f"{self.path}/rows/{load}"):
                if (load.partition("=")[2], day.partition("=")[2]) not in live:
                    remove_folder(self.spark, f"{self.path}/rows/{load}/{day}")
                    removed += 1
        return removed


def replace_days(spark: SparkSession, batch: DataFrame, path: str, key: str, open_ended: bool) -> None:
    """Replace day folders ``key=…`` of a table by the days of a batch.

    Only the days of the batch are rewritten, whatever the size of the table. With
    ``open_ended`` later days the batch lacks are dropped too (a range replacement).
    Running it again with the same batch leaves the same table.
    """
    (
        batch.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    if not open_ended:
        return
    # A list of days: a few hundred values at most.
    days = {str(row[0]) for row in batch.select(F.col(key).cast("string")).distinct().toLocalIterator()}
    if not days:
        return
    for name in subfolders(spark, path):
        day = name.removeprefix(f"{key}=")
        if name.startswith(f"{key}=") and day >= min(days) and day not in days:
            remove_folder(spark, f"{path}/{name}")
