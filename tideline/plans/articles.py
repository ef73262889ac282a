"""Article text: conversion, dead letters, the ordered table and its compaction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import as_timestamp
from ..functions.text import clean_text, html_text_mapper, html_to_text, text_md5
from ..operators.tables import clustered, compact_latest, newer_than_target

CONTENT_COLUMNS = ["resolved_id", "html", "text", "text_md5"]


def extract_article_text(articles: DataFrame, convert: Callable[[str], str] = html_to_text) -> DataFrame:
    """Adds text, its md5 and the error of a failed conversion.

    Only parsing runs in Python, in Arrow batches; every article is read whole.
    Failed rows stay, with null text.
    """
    rows = articles.withColumnRenamed("article", "html")
    fields = [*rows.schema.fields, T.StructField("raw_text", T.StringType()), T.StructField("error", T.StringType())]
    parsed = rows.mapInArrow(html_text_mapper(convert), T.StructType(fields))
    texts = parsed.withColumn("text", clean_text("raw_text")).drop("raw_text")
    return texts.withColumn("text_md5", text_md5("text"))


def content_rows(extracted: DataFrame, loaded_at) -> DataFrame:
    """Rows of the content table, failed ones included."""
    return extracted.select(
        F.col("resolved_id").cast("decimal(38,0)").alias("resolved_id"),
        "html",
        "text",
        "text_md5",
        as_timestamp(loaded_at).alias("loaded_at"),
    )


def dead_letter_split(df: DataFrame, error_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows without error, rows with error). Write or persist ``df`` first."""
    return df.filter(F.col(error_col).isNull()), df.filter(F.col(error_col).isNotNull())


def failure_rows(extracted: DataFrame, run_id: str, run_name: str, batch_id: int, loaded_at) -> DataFrame:
    """Dead letters of a batch."""
    _, failed = dead_letter_split(extracted, "error")
    key = F.col("object_key") if "object_key" in extracted.columns else F.lit(None).cast("string")
    return failed.select(
        F.lit(run_id).alias("flow_run_id"),
        F.lit(run_name).alias("flow_run_name"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("resolved_id").try_cast("bigint").alias("resolved_id"),
        key.alias("object_key"),
        "html",
        "error",
        as_timestamp(loaded_at).alias("loaded_at"),
    )


def new_ordered_rows(content: DataFrame, ordered: DataFrame, as_of) -> DataFrame:
    """Content newer than the ordered table (or than a day ago), in ranges of the id."""
    since = as_timestamp(as_of) - F.expr("INTERVAL 1 DAY")
    fresh = newer_than_target(content, ordered, "loaded_at", since)
    rows = fresh.withColumn("last_ordered", F.lit(None).cast("timestamp"))
    return clustered(rows, "resolved_id", ["loaded_at", "text_md5"])


def compact_ordered(ordered: DataFrame, as_of) -> DataFrame:
    """The ordered table with one row per article, the latest."""
    latest = compact_latest(ordered.drop("last_ordered"), "resolved_id", "loaded_at", as_of, ["text_md5"])
    return clustered(latest, "resolved_id")
