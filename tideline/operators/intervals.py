"""Batch intervals, day spines and staged-folder selection.

A plan has one row per interval: ``batch_start``, ``batch_end`` (half open),
``first_interval_start``, ``sets_end``, ``is_initial``, ``is_final``. No interval
crosses midnight, so a table is tagged with an equi-join on the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, day_of

_DAY = "INTERVAL 1 DAY"


def interval_plan(
    spark: SparkSession, last_offset, as_of=None, end=None, include_now: bool = False
) -> DataFrame:
    """Intervals from just after ``last_offset`` up to the last midnight.

    The piece from the last midnight to ``end`` (or to ``as_of``) is added when an
    explicit ``end`` is given or ``include_now`` is set. The plan is empty when
    nothing is left to do.
    """
    if last_offset is None:
        raise ValueError("no last offset: give an initial or an override offset")
    now = as_timestamp(as_of) if as_of is not None else F.current_timestamp()
    stop = as_timestamp(end) if end is not None else now
    with_rest = include_now or end is not None
    base = spark.range(1).select(
        (as_timestamp(last_offset) + F.expr("INTERVAL 1 MICROSECOND")).alias("start"),
        stop.alias("stop"),
    )
    start, stop = F.col("start"), F.col("stop")
    base = base.select(
        start,
        stop,
        (F.date_trunc("day", start) + F.expr(_DAY)).alias("first_midnight"),
        F.date_trunc("day", stop).alias("last_midnight"),
    )
    midnights = F.when(
        F.col("first_midnight") <= F.col("last_midnight"),
        F.sequence(F.col("first_midnight"), F.col("last_midnight"), F.expr(_DAY)),
    ).otherwise(F.array().cast("array<timestamp>"))
    bounds = F.concat(F.array(start), midnights)
    if with_rest:
        last = F.element_at(bounds, -1)
        bounds = F.when(stop > last, F.concat(bounds, F.array(stop))).otherwise(bounds)
    base = base.select(
        bounds.alias("bounds"),
        F.when(F.date_trunc("day", start) == start, start)
        .otherwise(F.col("first_midnight"))
        .alias("first_interval_start"),
    )
    pieces = base.withColumn("sets_end", F.element_at("bounds", -1)).select(
        "bounds",
        "first_interval_start",
        "sets_end",
        F.posexplode(F.slice("bounds", F.lit(1), F.size("bounds") - 1)).alias("i", "batch_start"),
    )
    return pieces.select(
        "batch_start",
        F.element_at("bounds", F.col("i") + 2).alias("batch_end"),
        "first_interval_start",
        "sets_end",
        (F.col("i") == 0).alias("is_initial"),
        (F.col("i") == F.size("bounds") - 2).alias("is_final"),
    )


def tag_batches(df: DataFrame, ts_col: str, plan: DataFrame) -> DataFrame:
    """Rows of ``df`` that fall into an interval of the plan, with its bounds.

    The least start and the greatest end reach the scan.
    """
    bounds = plan.select("batch_start", "batch_end", F.to_date("batch_start").alias("_batch_day"))
    ts = F.col(ts_col)
    df = df.filter((ts >= plan.select(F.min("batch_start")).scalar()) & (ts < plan.select(F.max("batch_end")).scalar()))
    matches = (
        (F.to_date(ts) == F.col("_batch_day"))
        & (ts >= F.col("batch_start"))
        & (ts < F.col("batch_end"))
    )
    return df.join(bounds, matches, "inner").drop("_batch_day")


def in_interval(ts, start, end) -> Column:
    """Half-open interval test."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return (column >= as_timestamp(start)) & (column < as_timestamp(end))


def rolling_days(ts, as_of) -> Column:
    """Calendar yesterday and today of ``as_of`` (UTC), written as a range on the
    timestamp itself so that it reaches the scan."""
    column = F.col(ts) if isinstance(ts, str) else ts
    today = F.date_trunc("day", as_timestamp(as_of))
    return (column >= today - F.expr(_DAY)) & (column < today + F.expr(_DAY))


def month_lookback(ts, start, end) -> Column:
    """From one calendar month before the day of ``start`` up to ``end``."""
    column = F.col(ts) if isinstance(ts, str) else ts
    first = F.add_months(day_of(start), -1).cast("timestamp")
    return (column >= first) & (column < as_timestamp(end))


def folder_names(ts) -> tuple[Column, Column]:
    """Values of the partition columns ``date`` and ``time`` of a batch."""
    column = as_timestamp(ts)
    return F.date_format(column, "yyyy-MM-dd"), F.date_format(column, fv.FOLDER_TIME_FORMAT)


def stale_partitions(
    paths: DataFrame, batch_start, first_interval_start, sets_end, path_col: str = "path"
) -> DataFrame:
    """Staged folders a re-run from ``batch_start`` up to ``sets_end`` replaces.

    Files of the first, partial day are dropped by their date/time folder, files of
    whole days by their date folder.
    """
    path = F.col(path_col)
    date = F.regexp_extract(path, r"/date=([0-9-]{10})/", 1)
    time = F.regexp_extract(path, r"/time=([0-9-]{12})/", 1)
    staged_at = F.try_to_timestamp(
        F.concat(date, F.lit(" "), time), F.lit("yyyy-MM-dd " + fv.FOLDER_TIME_FORMAT)
    )
    found = paths.select(date.alias("date"), time.alias("time"), staged_at.alias("at")).filter(
        in_interval("at", batch_start, sets_end)
    )
    whole_day = F.col("at") >= as_timestamp(first_interval_start)
    day_folder = F.concat(F.lit("date="), F.col("date"))
    return found.select(
        F.when(whole_day, day_folder)
        .otherwise(F.concat(day_folder, F.lit("/time="), F.col("time")))
        .alias("folder")
    ).distinct()


def day_spine(spark: SparkSession, first, last) -> DataFrame:
    """All days from ``first`` to ``last``, both included."""
    days = F.sequence(day_of(first), day_of(last), F.expr(_DAY))
    return spark.range(1).select(F.explode(days).alias("day"))


def missing_days(
    present: DataFrame, day_col: str, as_of, first=None, last=None, overwrite: bool = False
) -> DataFrame:
    """Days of the window without rows in ``present``, in order.

    The default window is the 14 days before ``as_of`` up to yesterday; with
    ``overwrite`` every day of the window is returned.
    """
    spark = present.sparkSession
    day = as_timestamp(as_of)
    start = as_timestamp(first) if first is not None else day - F.expr(f"INTERVAL {fv.REVENUE_DAYS_BACK} DAYS")
    stop = as_timestamp(last) if last is not None else day - F.expr(_DAY)
    expected = day_spine(spark, start, stop)
    if overwrite:
        return expected.orderBy("day")
    # Days are few, rows are many: the day list is what the anti-join keeps, and the
    # table is cut to its distinct days of the window first.
    loaded = (
        present.select(F.to_date(day_col).alias("day"))
        .filter((F.col("day") >= F.to_date(start)) & (F.col("day") <= F.to_date(stop)))
        .distinct()
    )
    return expected.join(loaded, "day", "left_anti").orderBy("day")
