"""Distinct counts, conditional sums and keyed sums that stay cheap under skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_flag_counts(
    df: DataFrame, group: Sequence[str], entity: str, flags: dict[str, Column]
) -> DataFrame:
    """Per group and flag: how many distinct entities have a row where the flag holds.

    Counting each flag with its own distinct aggregate multiplies every row by the
    number of flags before the shuffle. Here one pass marks the flags per (group,
    entity) and a second sums the marks: rows are combined on the map side in both,
    so neither a busy entity nor a busy group makes a hot task. Null entities count
    nowhere, but keep their group in the result.
    """
    marks = [F.max(F.when(flag, 1).otherwise(0)).alias(name) for name, flag in flags.items()]
    per_entity = df.groupBy(*group, entity).agg(*marks)
    known = F.col(entity).isNotNull()
    sums = [F.sum(F.when(known, F.col(name)).otherwise(0)).alias(name) for name in flags]
    return per_entity.groupBy(*group).agg(*sums)


def sum_when(condition: Column, value: Column | int = 1) -> Column:
    """Sum of ``value`` over rows where the condition holds, 0 elsewhere."""
    value = F.lit(value) if isinstance(value, int) else value
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def sum_by_keys(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sums per key; rows with a null in any key are left out."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
