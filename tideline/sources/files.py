"""Readers: staged Parquet with lineage, pipe text, NDJSON objects, API pages, JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp
from ..operators.checks import require_rows

ARTICLE_SCHEMA = "resolved_id STRING, article STRING"


def column_definitions(table_def: str) -> list[tuple[str, str, bool]]:
    """(name, type, required) of a list like ``"day date not null, feed string"``."""
    types = {"number": "bigint", "integer": "bigint", "float": "double", "varchar": "string"}
    result = []
    for part in table_def.split(","):
        name, data_type, *rest = part.split()
        result.append((name, types.get(data_type.lower(), data_type.lower()), rest[:2] == ["not", "null"]))
    return result


def typed_load(
    spark: SparkSession,
    path: str,
    columns: Sequence[tuple[str, str]],
    loaded_at=None,
    lineage: bool = True,
) -> DataFrame:
    """Staged Parquet files as typed columns plus where each row came from.

    The file's folder names are taken from its path, so the layout
    ``date=…/time=…/file`` needs no partition discovery.
    """
    typed = [F.col(name).cast(data_type).alias(name) for name, data_type in columns]
    files = spark.read.option("recursiveFileLookup", "true").parquet(path)
    if not lineage:
        return files.select(*typed)
    name = F.col("_metadata.file_path")
    moment = as_timestamp(loaded_at) if loaded_at is not None else F.current_timestamp()
    values = [
        name,
        F.col("_metadata.row_index"),
        F.split_part(name, F.lit("/"), F.lit(-3)),
        F.split_part(name, F.lit("/"), F.lit(-2)),
        moment,
    ]
    lineage_columns = [
        value.cast(data_type).alias(column)
        for value, (column, data_type) in zip(values, fv.LINEAGE_COLUMNS, strict=True)
    ]
    return files.select(*typed, *lineage_columns)


def pipe_csv(
    spark: SparkSession, path: str, columns: Sequence[str], loaded_at_col: str | None = None, loaded_at=None
) -> DataFrame:
    """Pipe-delimited text with all columns as text, plus the load time."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # Quotes inside a value are doubled, so a reader of plain CSV agrees with this one.
    rows = (
        spark.read.schema(schema)
        .option("sep", "|")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", "true")
        .csv(path)
    )
    if loaded_at_col is None:
        return rows
    moment = as_timestamp(loaded_at) if loaded_at is not None else F.current_timestamp()
    return rows.withColumn(loaded_at_col, moment)


def ndjson_objects(spark: SparkSession, path: str, schema: str = ARTICLE_SCHEMA) -> DataFrame:
    """One JSON object per line, gzip or plain, with the object's key; no rows is an error."""
    rows = spark.read.schema(schema).json(path).withColumn("object_key", F.col("_metadata.file_path"))
    return require_rows(rows, f"no files to process below {path}")


def header_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and optional quotes; one malformed row fails the load."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", "true")
        .csv(path)
    )


def page_records(pages: DataFrame, columns: Sequence[str], archived: bool = False) -> DataFrame:
    """Records of landed API pages (``data``: array of maps) with plain column names.

    The prefix before the dot is cut from the keys; dimensions an archived page lacks
    become null.
    """
    prefix = fv.REVENUE_PREFIX_ARCHIVED if archived else fv.REVENUE_PREFIX
    record = F.col("record")
    rows = pages.select(F.explode("data").alias("record"))
    return rows.select(*[F.element_at(record, F.lit(f"{prefix}.{c}")).alias(c) for c in columns])


def landed_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema("data ARRAY<MAP<STRING, STRING>>").option("multiLine", "true").json(path)


def jdbc_table(
    spark: SparkSession, url: str, query: str, batch_size: int = 100_000,
    partition_by: str | None = None, lower=None, upper=None, partitions: int | None = None, **options,
) -> DataFrame:
    """A query of a database, fetched in batches.

    With ``partition_by``, a numeric, date or time column of the query, and the bounds of
    its values, ``partitions`` tasks read a range each; the bounds leave no row out.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS source_rows")
    if partition_by is not None:
        reader = reader.options(partitionColumn=partition_by, lowerBound=lower, upperBound=upper, numPartitions=partitions)
    return reader.option("fetchsize", batch_size).options(**options).load()
