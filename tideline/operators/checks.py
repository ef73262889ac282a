"""Checks on schemas and rows. Row checks ride in the plan or take one aggregate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def required_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise KeyError(f"input is missing columns: {missing}")
    return df


def not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows; the job fails on the first null in one of the columns."""
    checked = {
        name: F.when(F.col(name).isNull(), F.raise_error(F.lit(f"null in required column {name}"))).otherwise(
            F.col(name)
        )
        for name in names
    }
    return df.withColumns(checked)


def write_checked(df: DataFrame, write: Callable[[DataFrame], None], forbidden: Mapping[str, Column]) -> dict[str, int]:
    """Writes ``df`` and raises if rows hold what is ``forbidden``: (what is wrong, condition) pairs.

    The rows are counted while they are written, in no pass of their own, and all kinds
    are told at once. What ``write`` leaves must not count yet when this raises.
    """
    if not forbidden:
        write(df)
        return {}
    seen = Observation()
    counts = {f"n{i}": F.count_if(F.coalesce(condition, F.lit(False))).alias(f"n{i}") for i, condition in enumerate(forbidden.values())}
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts.values()))
    got = seen.get
    wrong = {name: got.get(f"n{i}", 0) for i, name in enumerate(forbidden) if got.get(f"n{i}", 0)}
    if wrong:
        raise ValueError(f"rows that must not be there, of {got['rows']}: {wrong}")
    return got


def corpus_item_violations(items: DataFrame, sets: DataFrame, set_col: str) -> DataFrame:
    """Sets whose items break a rule: too few, or an empty id or topic.

    ``sets`` has ``set_col`` and ``min_item_count``. Only offending sets are returned.
    """
    bad = F.col("id").isNull() | (F.col("id") == "") | F.col("topic").isNull() | (F.col("topic") == "")
    counted = items.groupBy(set_col).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("bad_items"),
    )
    joined = sets.select(set_col, "min_item_count").join(counted, set_col, "left")
    checked = joined.na.fill(0, ["item_count", "bad_items"])
    return checked.filter((F.col("item_count") < F.col("min_item_count")) | (F.col("bad_items") > 0))


def legacy_item_violations(items: DataFrame, sets: DataFrame, set_col: str) -> DataFrame:
    """Sets without items, or with an item that lacks its id or publisher."""
    bad = F.col("id").isNull() | F.col("publisher").isNull() | (F.col("publisher") == "")
    counted = items.groupBy(set_col).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("bad_items"),
    )
    joined = sets.select(set_col).join(counted, set_col, "left").na.fill(0, ["item_count", "bad_items"])
    return joined.filter((F.col("item_count") < 1) | (F.col("bad_items") > 0))


def exactly_one_id(external_id: Column, alias: Column) -> Column:
    """True where exactly one of the two identifiers is given."""
    return external_id.isNotNull() != alias.isNotNull()


def require_none(violations: DataFrame, message: str) -> None:
    """Raise when the frame has rows; at most ten are fetched for the message."""
    found = violations.limit(10).collect()
    if found:
        raise ValueError(f"{message}: {found}")


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df
