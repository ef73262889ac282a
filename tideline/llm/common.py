"""Helpers the operators of this package share."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialized

#: The white space that parts words: the blank and the control characters 9 to 13.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Texts are worked through in runs of about this many characters and at most this many texts.
RUN_CHARS = 1 << 20
RUN_TEXTS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; read by Spark, so any store it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: later jobs start from files."""
    return materialized(df, f"llm-{name}")


def text_batches(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Record batches cut to runs of bounded text, each with its texts; a null text counts as empty."""
    for whole in batches:
        for at in range(0, whole.num_rows, RUN_TEXTS):
            batch = whole.slice(at, RUN_TEXTS)
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            first, size = 0, 0
            for i, value in enumerate(texts):
                size += len(value)
                if size >= RUN_CHARS or i == len(texts) - 1:
                    yield batch.slice(first, i + 1 - first), texts[first : i + 1]
                    first, size = i + 1, 0


def spread_key(*columns: str) -> Column:
    """A text that orders rows at random but always alike; SQL engines with md5 can repeat it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(":", *parts))


def running_totals(df: DataFrame, groups: Sequence[str], key: str, ties: Sequence[str], value: str, rows: int) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same group that come earlier by ``key``.

    ``key`` is a :func:`spread_key`. A group is cut into about sqrt(``rows``) buckets by
    the first digits of the key, so that neither the sums of the buckets nor the rows of
    one bucket ever meet in a task that grows with a hot group. ``ties`` order equal keys.
    """
    buckets = max(1, math.isqrt(max(rows, 1)))
    number = F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") * F.lit(buckets) / F.lit(float(1 << 32)))
    cut = df.withColumn("_bucket", number.cast("int"))
    sums = cut.groupBy(*[F.col(g).alias(f"_{g}") for g in groups], F.col("_bucket").alias("_b")).agg(
        F.sum(value).alias("_sum")
    )
    earlier = Window.partitionBy(*[f"_{g}" for g in groups]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_earlier", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    same = F.col("_bucket") == F.col("_b")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = cut.join(sums, same)
    total = F.col("_earlier") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumn("before", total.cast("bigint")).drop("_bucket", "_b", "_earlier", *[f"_{g}" for g in groups])
