"""Features of publishers: recent saves and approved items by topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, iso8601
from ..operators.checks import required_columns
from ..operators.counting import sum_when

_APPROVED = [f"num_approved_{name}" for _, name in fv.APPROVED_TOPICS] + ["num_approved"]


def recent_saves(
    content: DataFrame, engagement: DataFrame, scheduled: DataFrame, as_of, own_domains: Sequence[int] = ()
) -> DataFrame:
    """Domains with the most saves of fresh, unscheduled English long texts, without the publisher's ``own_domains``.

    The daily engagement is folded per content id before it is joined: the sum of
    saves times age is (sum of saves times day number) minus (saves times the day
    the content appeared), so no daily row has to travel.
    """
    today = F.to_date(as_timestamp(as_of))
    start = F.date_sub(today, fv.PUBLISHER_WINDOW_DAYS)
    day = F.col("happened_at")
    # an expression and its bounds are compared as times: the last bound is midnight
    saves = (
        engagement.filter(day.between(start, today) & (F.col("save_count") > 0))
        .groupBy("content_id")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("save_count").alias("saves"),
            F.sum(F.col("save_count") * F.unix_date(F.to_date(day))).alias("saves_by_day"),
        )
    )
    fresh = content.filter(
        F.col("first_parsed_at").between(start, today)
        & (F.col("language") == fv.PUBLISHER_LANGUAGE)
        & (F.col("word_count") >= fv.PUBLISHER_MIN_WORDS)
        & ~F.col("domain_id").isin(list(own_domains))
    ).select("content_id", "top_domain_name", "resolved_url", F.unix_date(F.to_date("first_parsed_at")).alias("parsed"))
    unscheduled = fresh.join(scheduled.select("content_id"), "content_id", "left_anti")
    per_content = unscheduled.join(saves, "content_id", "inner").withColumn(
        "saves_by_age", F.col("saves_by_day") - F.col("saves") * F.col("parsed")
    )
    # distinct urls per domain: first per (domain, url), then per domain
    per_url = per_content.groupBy("top_domain_name", "resolved_url").agg(
        F.sum("days").alias("days"), F.sum("saves").alias("saves"), F.sum("saves_by_age").alias("saves_by_age")
    )
    domains = per_url.groupBy("top_domain_name").agg(
        F.count("resolved_url").alias("num_items_saved"),
        (F.sum("saves_by_age").cast("double") / F.sum("days")).alias("avg_save_age"),
        F.sum("saves").alias("total_save_count"),
    )
    return domains


def approved_by_topic(content: DataFrame, approved: DataFrame, as_of) -> DataFrame:
    """Domains with the most approved items, counted by topic."""
    since = F.date_sub(F.to_date(as_timestamp(as_of)), fv.PUBLISHER_APPROVED_DAYS)
    topics = approved.filter(F.col("topic").isNotNull() & (F.col("reviewed_corpus_item_created_at") > since))
    # fold the approvals to one row per (content, topic) before joining
    per_content = topics.groupBy("content_id", "topic").agg(F.count(F.lit(1)).alias("items"))
    joined = per_content.join(content.select("content_id", "top_domain_name"), "content_id", "inner")
    domains = joined.groupBy(F.col("top_domain_name").alias("approved_source")).agg(
        *[
            sum_when(F.col("topic") == topic, F.col("items")).alias(f"num_approved_{name}")
            for topic, name in fv.APPROVED_TOPICS
        ],
        sum_when(F.col("topic") != fv.EXCLUDED_TOPIC, F.col("items")).alias("num_approved"),
    )
    return domains


def finish_features(rows: DataFrame) -> DataFrame:
    """Drop rows without domain, format the time, and fill missing approvals with 0."""
    required_columns(rows, ["top_domain_name", "log_total_saves", "total_save_count", "updated_at"])
    approved = [c for c in rows.columns if c.startswith("num_approved")]
    filled = rows.drop("approved_source").na.drop(subset=["top_domain_name"])
    return filled.withColumns(
        {
            "updated_at": iso8601("updated_at"),
            **{c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in approved},
        }
    )


def publisher_features(
    content: DataFrame, engagement: DataFrame, approved: DataFrame, scheduled: DataFrame, as_of, own_domains: Sequence[int] = ()
) -> DataFrame:
    saves = recent_saves(content, engagement, scheduled, as_of, own_domains)
    topics = approved_by_topic(content, approved, as_of)
    joined = saves.join(topics, saves["top_domain_name"] == topics["approved_source"], "left")
    rows = joined.select(
        "top_domain_name",
        "approved_source",
        *_APPROVED,
        "total_save_count",
        "avg_save_age",
        (F.col("total_save_count").cast("double") / F.col("num_items_saved")).alias("avg_save_count"),
        "num_items_saved",
        F.ln("total_save_count").alias("log_total_saves"),
        as_timestamp(as_of).alias("updated_at"),
    )
    return finish_features(rows)
