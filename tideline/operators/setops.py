"""Set operations and anti-joins on frames of equal columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_frames(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name; missing columns become null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def union_distinct(*frames: DataFrame) -> DataFrame:
    return concat_frames(*frames).distinct()


def without_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without partner; what a left join with an IS NULL test returns."""
    return left.join(right.select(*on), list(on), "left_anti")


def left_join_filtered(left: DataFrame, right: DataFrame, on: Sequence[str], right_filter: Column) -> DataFrame:
    """Left join whose ON clause also tests the right side: the test goes first."""
    return left.join(right.filter(right_filter), list(on), "left")


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all columns of equal name."""
    shared = [c for c in left.columns if c in right.columns]
    return left.join(right, shared, "inner")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def add_constants(df: DataFrame, constants: dict) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})
