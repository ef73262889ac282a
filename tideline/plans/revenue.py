"""Daily revenue: missing days, landed pages, typed rows, replacement by day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed_values as fv
from ..operators.checks import require_none
from ..operators.intervals import missing_days
from ..operators.tables import key_replace
from ..sources.files import landed_pages, page_records
from ..sources.tables import DayTable

_NAMES = [name for name, _ in fv.REVENUE_COLUMNS]


def typed_rows(records: DataFrame) -> DataFrame:
    return records.select(*[F.col(name).cast(data_type).alias(name) for name, data_type in fv.REVENUE_COLUMNS])


def revenue_rows(pages: DataFrame, archived: bool = False) -> DataFrame:
    """Typed rows of landed pages; dimensions absent from archived pages are null."""
    return typed_rows(page_records(pages, _NAMES, archived))


def days_without_rows(days: DataFrame, rows: DataFrame) -> DataFrame:
    """Requested days that got no row; a load must fail on them."""
    return days.join(rows.select(F.col("record_date").alias("day")).distinct(), "day", "left_anti")


def days_to_load(revenue: DataFrame, as_of, first=None, last=None, overwrite: bool = False) -> DataFrame:
    return missing_days(revenue, "record_date", as_of, first, last, overwrite)


def revenue_key_replace(revenue: DataFrame, batch: DataFrame) -> DataFrame:
    """The table with all days of the batch replaced by the batch."""
    return key_replace(revenue, batch, "record_date")


def revenue_table(spark: SparkSession, path: str) -> DayTable:
    """The revenue table in day folders, empty where nothing is loaded yet."""
    schema = StructType.fromDDL(", ".join(f"{name} {data_type}" for name, data_type in fv.REVENUE_COLUMNS))
    return DayTable(spark, path, "record_date", schema)


def load_missing_days(
    spark: SparkSession,
    table: DayTable,
    pages_of: Callable[[str], str],
    as_of,
    first=None,
    last=None,
    overwrite: bool = False,
    archived: bool = False,
) -> DataFrame:
    """Load the days the table lacks from their landed pages and return the new table.

    ``pages_of`` gives the folder of a day's pages. All days are read and written in one
    job; a day without rows fails the load before it counts; only the loaded days are written.
    """
    revenue = table.read()
    days = days_to_load(revenue, as_of, first, last, overwrite)
    folders = [pages_of(str(row["day"])) for row in days.collect()]  # a window of days
    if not folders:
        return revenue

    def complete(written: list[str]) -> None:
        held = spark.createDataFrame([(day,) for day in written], "day string")
        rows = held.select(F.col("day").cast("date").alias("record_date"))
        require_none(days_without_rows(days, rows), "days without any record (archived data?)")

    table.replace(revenue_rows(landed_pages(spark, folders), archived), "days", accept=complete)
    return table.read()
