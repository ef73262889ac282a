"""Numbered chunks of bounded size, also for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized

#: As size: one list per group, in its order, whatever its length.
ONE_LIST = (1 << 31) - 1


def chunk_rows(
    df: DataFrame, size: int | Column, group: Sequence[str], order: Sequence[Column], spread_by: Sequence[str]
) -> DataFrame:
    """Adds ``row_no`` and ``chunk_no``: the rows of a group from 1 in their order, and chunks of ``size`` rows.

    The rows are sorted by group and order into ranges of about equal size, however
    large a group is, and written once: a row's number is its place in its range plus
    the rows that earlier ranges hold of its group. Only these counts, one per range
    and group in it, are summed up. ``spread_by`` (columns that tell the rows apart)
    orders ties, so that a range can end between them.
    """
    keys = [*[F.asc(g) for g in group], *order, *[F.asc(c) for c in spread_by]]
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = {"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}
    rows = materialized(ranges.withColumns(placed), "chunk-rows")
    counts = rows.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_range").alias("_r")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(*[f"_g_{g}" for g in group]).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    same = F.col("_range") == F.col("_r")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    row_no = (F.col("_before") + F.col("_place") - F.col("_first") + 1).cast("bigint")
    numbered = rows.join(counts, same).withColumn("row_no", row_no)
    chunk = F.floor((F.col("row_no") - 1) / (F.lit(size) if isinstance(size, int) else size))
    helpers = ["_range", "_place", "_r", "_first", "_before", *[f"_g_{g}" for g in group]]
    return numbered.withColumn("chunk_no", chunk.cast("bigint")).drop(*helpers)


def collect_chunks(df: DataFrame, group: Sequence[str], items: dict[str, Column]) -> DataFrame:
    """One row per chunk of :func:`chunk_rows` with its rows as ordered arrays.

    ``items`` names the arrays; a null element is left out of its array. The size of
    an array is bounded by the chunk size.
    """
    packed = F.struct("row_no", *[column.alias(f"_{name}") for name, column in items.items()])
    ordered = F.array_sort(F.collect_list(packed))
    rows = df.groupBy(*group, "chunk_no").agg(ordered.alias("_items"))
    arrays = [_field_array(f"_{name}").alias(name) for name in items]
    row_count = F.size("_items").cast("bigint").alias("row_count")
    return rows.select(*group, "chunk_no", row_count, *arrays)


def at_most(lists: DataFrame, limit: int | None) -> DataFrame:
    """Fails the job on a list of more than ``limit`` items; lists are never cut or split for it."""
    if limit is None:
        return lists
    count = F.col("row_count")
    checked = F.when(count > limit, F.raise_error(F.concat(F.lit("list too long: "), count.cast("string")))).otherwise(count)
    return lists.filter(checked.isNotNull())


def _field_array(field: str) -> Column:
    """The non-null values of one field of the collected structs, in their order."""
    return F.filter(F.transform("_items", lambda item: item[field]), lambda value: value.isNotNull())
