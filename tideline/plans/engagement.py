"""Trailing engagement of recommended items, user impressions, item projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, iso8601, slash_key
from ..operators.chunks import ONE_LIST, at_most, chunk_rows, collect_chunks
from ..operators.counting import sum_by_keys
from ..operators.setops import add_constants, concat_frames, natural_join

_ITEM_KEYS = ["recommendation_surface_id", "corpus_slate_configuration_id", "corpus_item_id"]


def item_keys(recommendations: DataFrame, join_col: str, as_of) -> DataFrame:
    """Distinct item keys of recent recommendations; an id may have several keys."""
    since = as_timestamp(as_of) - F.expr(f"INTERVAL {fv.RECOMMENDATION_DAYS} DAYS")
    recent = recommendations.filter(F.col("recommended_at") > since)
    return recent.select(join_col, slash_key(*_ITEM_KEYS).alias("key"), *_ITEM_KEYS).distinct()


def with_item_keys(telemetry: DataFrame, recommendations: DataFrame, join_col: str, as_of) -> DataFrame:
    """Telemetry by item key instead of by recommendation or tile id."""
    return natural_join(telemetry, item_keys(recommendations, join_col, as_of)).drop(join_col)


def aggregate_engagement(nested: DataFrame, legacy: DataFrame, recommendations: DataFrame, as_of) -> DataFrame:
    """Counters of both telemetry sources per item key.

    The time of the last event is part of the key, so rows of one item merge only
    when it is equal. Counters of the longer windows are zero.
    """
    both = concat_frames(
        with_item_keys(nested, recommendations, "corpus_recommendation_id", as_of),
        with_item_keys(legacy, recommendations, "tile_id", as_of),
    )
    return sum_engagement(both)


def sum_engagement(rows: DataFrame) -> DataFrame:
    """Sum by the engagement key; the counters of longer windows are added as zero."""
    summed = sum_by_keys(rows, fv.ENGAGEMENT_KEY, fv.TRAILING_COUNTERS[:2])
    zeros = {name: 0 for name in fv.TRAILING_COUNTERS[2:]}
    return add_constants(summed, zeros)


def corpus_item_engagement(trailing: DataFrame) -> DataFrame:
    """Projection of the trailing counters with the day as ISO time."""
    return trailing.select(
        F.col("surface_configuration_item_key").alias("key"),
        iso8601("updated_at_day").alias("updated_at"),
        *_ITEM_KEYS,
        *fv.TRAILING_COUNTERS,
    )


def user_impressions(
    impressions: DataFrame,
    recommendations: DataFrame,
    as_of,
    max_count: int = fv.IMPRESSION_MAX_COUNT,
    max_age_days: int = fv.IMPRESSION_MAX_AGE_DAYS,
    max_ids: int | None = None,
) -> DataFrame:
    """Items a user has seen often, or first saw long ago, as a bracketed list.

    Impressions are folded per recommendation before the join, and items per user
    before they are listed. A user is one row; one of more than ``max_ids`` items,
    if given, fails the job.
    """
    today = F.date_trunc("day", as_timestamp(as_of))
    window_start = today - F.expr(f"INTERVAL {fv.IMPRESSION_WINDOW_DAYS} DAYS")
    seen = (
        impressions.filter(F.col("happened_at") > window_start)
        .groupBy("corpus_recommendation_id")
        .agg(F.count(F.lit(1)).alias("seen"), F.min("happened_at").alias("first_seen"))
    )
    known = recommendations.filter(F.col("hashed_user_id").isNotNull()).select(
        "corpus_recommendation_id", "hashed_user_id", "corpus_item_id"
    )
    per_item = (
        seen.join(known, "corpus_recommendation_id", "inner")
        .groupBy("hashed_user_id", "corpus_item_id")
        .agg(F.sum("seen").alias("impression_count"), F.min("first_seen").alias("first_impression_time"))
    )
    # The union of "often" and "long ago" without its duplicates is one OR over unique rows.
    long_ago = F.col("first_impression_time") < today - F.expr(f"INTERVAL {int(max_age_days)} DAYS")
    listed = per_item.filter((F.col("impression_count") > max_count) | long_ago)
    chunked = chunk_rows(listed, ONE_LIST, ["hashed_user_id"], [F.asc("corpus_item_id")], ["corpus_item_id"])
    rows = collect_chunks(chunked, ["hashed_user_id"], {"ids": F.col("corpus_item_id").cast("string")})
    rows = at_most(rows, max_ids)
    return rows.select(
        "hashed_user_id",
        iso8601(today).alias("updated_at"),
        F.concat(F.lit("["), F.array_join("ids", ","), F.lit("]")).alias("corpus_ids"),
    )
