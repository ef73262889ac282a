"""Approximate distinct counts over trailing windows, from one mergeable sketch per pane and key.

A pane is a short tumbling window. Rows are folded into the sketch of their pane once;
longer windows unite the sketches of their panes, so no row is copied to the windows that
hold it, and a stream keeps one sketch per open pane.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two.
LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of the estimate of united sketches."""
    return 1.04 / math.sqrt(1 << lg_k)


def within_error(estimate: Column, exact: Column, lg_k: int = LG_K, errors: float = 3.0) -> Column:
    """Whether an estimate lies within some standard errors of the exact count."""
    return F.abs(estimate - exact) <= exact * F.lit(errors * standard_error(lg_k))


def pane_sketches(
    df: DataFrame, ts_col: str, keys: Sequence[str], counted: dict[str, Column], pane: str = "15 minutes", lg_k: int = LG_K
) -> DataFrame:
    """One row per pane and key: ``pane`` (its start), ``updated_at`` (the latest time) and a sketch per counted value.

    ``counted`` names columns whose distinct values count; nulls do not. Sketches are
    combined on the map side. Works on streams, where the panes are the state.
    """
    sketches = [F.hll_sketch_agg(value, lg_k).alias(name) for name, value in counted.items()]
    folded = df.groupBy(F.window(ts_col, pane).alias("_window"), *keys).agg(F.max(ts_col).alias("updated_at"), *sketches)
    return folded.select(F.col("_window.start").alias("pane"), *keys, "updated_at", *counted)


def united(panes: DataFrame, keys: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """Estimates per key over all given panes, with their latest time."""
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in counted]
    return panes.groupBy(*keys).agg(F.max("updated_at").alias("updated_at"), *estimates)


def trailing_windows(panes: DataFrame, keys: Sequence[str], counted: Sequence[str], length: int, slide: int) -> DataFrame:
    """Estimates of every window of ``length`` seconds that starts at a multiple of ``slide`` and holds a pane.

    Panes must not cross a multiple of ``slide``, and ``length`` is a multiple of it.
    What is copied to the windows of a pane is its key and time alone; the sketches stay in
    one row each and are read through a range frame. A key's panes meet in one task: their
    number follows the time span, not the rows.
    """
    if length % slide:
        raise ValueError("length must be a multiple of slide")
    at = F.unix_timestamp("pane")
    first = at - at % slide
    starts = panes.select(*keys, F.explode(F.sequence(first - (length - slide), first, F.lit(slide))).alias("_at")).distinct()
    held = panes.select(*keys, at.alias("_at"), "updated_at", *counted, F.lit(False).alias("_start"))
    rows = held.unionByName(starts.withColumn("_start", F.lit(True)), allowMissingColumns=True)
    frame = Window.partitionBy(*keys).orderBy("_at").rangeBetween(0, length - 1)
    windows = rows.select(
        "_start", "_at", *keys, F.max("updated_at").over(frame).alias("updated_at"),
        *[F.hll_sketch_estimate(F.hll_union_agg(name).over(frame)).alias(name) for name in counted],
    )
    start = F.timestamp_seconds("_at")
    return windows.filter("_start").select(
        start.alias("window_start"), (start + F.make_dt_interval(secs=F.lit(length))).alias("window_end"), *keys, "updated_at", *counted
    )
