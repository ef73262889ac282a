"""Candidate sets keyed by resolved ids, with a feed id per set.

Every function returns

    candidate_set_id, feed_id, id, publisher, recency

and takes the newest ``n`` rows of each set with a per-set rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp
from ..operators.latest import top_n_per_group

_OUTPUT = ["candidate_set_id", "feed_id", "id", "publisher", "recency"]


def _params(df: DataFrame, sets: Sequence[dict], columns: dict[str, str]) -> DataFrame:
    rows = [tuple(s.get(name) for name in columns) for s in sets]
    schema = ", ".join(f"{name} {data_type}" for name, data_type in columns.items())
    return df.sparkSession.createDataFrame(rows, schema)


def _newest(df: DataFrame, n: int) -> DataFrame:
    order = [F.desc("recency"), F.asc("id"), F.asc("publisher")]
    return top_n_per_group(df, "candidate_set_id", order, n)


def _since(as_of, days: int) -> Column:
    return as_timestamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def _reviewed(approved: DataFrame, as_of) -> DataFrame:
    return approved.filter(
        (F.col("reviewed_corpus_item_updated_at") >= _since(as_of, fv.LEGACY_REVIEW_DAYS))
        & (F.col("corpus_review_status") == fv.REVIEW_STATUS)
    ).select(
        "content_id", F.col("resolved_id").alias("id"), "topic", "language", "scheduled_surface_id",
        "is_syndicated", F.col("reviewed_corpus_item_updated_at").alias("recency"),
    )


def _reads(approved: DataFrame, content: DataFrame, as_of, sets: Sequence[dict], words: Column) -> DataFrame:
    params = _params(
        approved, sets,
        {"candidate_set_id": "string", "language": "string", "scheduled_surface_id": "string", "feed_id": "bigint"},
    )
    items = _reviewed(approved, as_of).filter(~F.col("is_syndicated"))
    in_sets = items.join(params, ["language", "scheduled_surface_id"], "inner")
    sized = content.filter(words).select("content_id", F.col("top_domain_name").alias("publisher"))
    return _newest(in_sets.join(sized, "content_id", "inner"), fv.READS_LIMIT).select(*_OUTPUT)


def longreads(approved: DataFrame, content: DataFrame, as_of, sets=fv.LEGACY_LONGREADS) -> DataFrame:
    return _reads(approved, content, as_of, sets, F.col("word_count") >= fv.LONGREAD_MIN_WORDS)


def shortreads(approved: DataFrame, content: DataFrame, as_of, sets=fv.LEGACY_SHORTREADS) -> DataFrame:
    return _reads(approved, content, as_of, sets, F.col("word_count") <= fv.SHORTREAD_MAX_WORDS)


def curated_feeds(scheduled: DataFrame, content: DataFrame, as_of, sets=fv.LEGACY_CURATED_FEEDS) -> DataFrame:
    """Items scheduled in the last week.

    The newest 300 are taken first; only then collections are picked, or else
    syndicated items dropped.
    """
    params = _params(
        scheduled, sets,
        {"candidate_set_id": "string", "scheduled_surface_id": "string", "feed_id": "bigint",
         "collections_only": "boolean", "not_syndicated": "boolean"},
    )
    when = F.col("scheduled_corpus_item_scheduled_at")
    items = scheduled.filter(when.between(_since(as_of, fv.CURATED_FEED_DAYS), as_timestamp(as_of))).select(
        "content_id", F.col("resolved_id").alias("id"), "scheduled_surface_id", "is_collection", "is_syndicated",
        when.alias("recency"),
    )
    in_sets = items.join(params, "scheduled_surface_id", "inner")
    publishers = content.select("content_id", F.col("top_domain_name").alias("publisher"))
    newest = _newest(in_sets.join(publishers, "content_id", "inner"), fv.CURATED_FEED_LIMIT)
    kept = (
        F.when(F.col("collections_only"), F.col("is_collection"))
        .when(F.col("not_syndicated"), ~F.col("is_syndicated"))
        .otherwise(F.lit(True))
    )
    return newest.filter(kept).select(*_OUTPUT)


def syndicated_feed(scheduled: DataFrame, syndicated: DataFrame, as_of, sets=fv.LEGACY_SYNDICATED) -> DataFrame:
    """Scheduled items that have a syndicated article; the publisher is its domain."""
    params = _params(scheduled, sets, {"candidate_set_id": "string", "scheduled_surface_id": "string"})
    when = F.col("scheduled_corpus_item_scheduled_at")
    items = scheduled.filter(when.between(_since(as_of, fv.SYNDICATED_DAYS), as_timestamp(as_of))).select(
        F.col("resolved_id").alias("id"), "scheduled_surface_id", when.alias("recency")
    )
    in_sets = items.join(params, "scheduled_surface_id", "inner")
    articles = syndicated.select(F.col(fv.SYNDICATED_KEY).alias("id"), F.col("domain").alias("publisher"))
    joined = in_sets.join(articles, "id", "inner").withColumn("feed_id", F.lit(fv.FEED_ID_EN_US).cast("bigint"))
    return _newest(joined, fv.SYNDICATED_LIMIT).select(*_OUTPUT)


def legacy_topics(approved: DataFrame, content: DataFrame, topics: DataFrame, as_of) -> DataFrame:
    """The newest English items of each topic."""
    params = topics.select(
        F.col("legacy_curated_catalog_candidate_set_id").alias("candidate_set_id"),
        F.col("corpus_topic_id").alias("topic"),
    )
    items = _reviewed(approved, as_of).filter(F.col("language") == "EN").join(params, "topic", "inner")
    publishers = content.select("content_id", F.col("top_domain_name").alias("publisher"))
    joined = items.join(publishers, "content_id", "inner").withColumn(
        "feed_id", F.lit(fv.FEED_ID_EN_US).cast("bigint")
    )
    return _newest(joined, fv.LEGACY_TOPIC_LIMIT).select(*_OUTPUT)
