"""Full exports of the curated-feed tables as pipe text, and their reload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import zoned_to_utc
from ..operators.tables import full_refresh
from ..sources.files import pipe_csv
from ..sources.tables import pipe_export

_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def export_rows(table: DataFrame, name: str, zone: str = "UTC") -> DataFrame:
    """Columns of the export: unix times and local times become UTC time texts."""
    columns, unix_columns, local_columns = fv.CURATED_FEEDS[name]
    result = []
    for column in columns:
        if column in unix_columns:
            value = F.date_format(F.timestamp_seconds(column), _TIME_FORMAT)
        elif column in local_columns:
            value = F.date_format(zoned_to_utc(column, zone), _TIME_FORMAT)
        else:
            value = F.col(column).cast("string")
        result.append(value.alias(column))
    return table.select(*result)


def export_table(table: DataFrame, name: str, path: str, zone: str = "UTC") -> None:
    pipe_export(export_rows(table, name, zone), path)


def load_table(spark: SparkSession, name: str, path: str, loaded_at) -> DataFrame:
    """The whole exported table as text with its load time; replaces the old load."""
    columns = fv.CURATED_FEEDS[name][0]
    return full_refresh(pipe_csv(spark, path, columns), columns, loaded_at, fv.LOADED_AT_COLUMN)
