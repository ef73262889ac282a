"""Candidate sets of corpus items.

Sets of one kind are computed together: their parameters are a small frame that is
joined on surface, language or topic, so the item tables are read once per kind and
not once per set. Every function returns

    candidate_set_id, id, topic, publisher, recency

with at most one row per (set, id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, iso8601
from ..operators.latest import latest_per_key, top_n_per_group
from ..operators.setops import concat_frames
from ..sources.records import item_messages

_SET_SCHEMA = {
    "collections_by_recency": "candidate_set_id string, language string, scheduled_surface_id string, max_age_days int",
    "life_hacks": "candidate_set_id string, scheduled_surface_id string, max_age_days int",
    "daily_hits": "candidate_set_id string, scheduled_surface_id string",
    "scheduled_items": "candidate_set_id string, scheduled_surface_id string, max_age_days int",
    "recommended_by_recency": "candidate_set_id string, scheduled_surface_id string, n_per_topic int",
}
_OUTPUT = ["candidate_set_id", "id", "topic", "publisher", "recency"]
_ID_AND_SET = ["id", "candidate_set_id"]
_TIES = ["topic", "publisher"]


def static_sets(spark: SparkSession, kind: str, sets: Sequence[dict] | None = None) -> DataFrame:
    """Parameters of the fixed sets of a kind, or of the given ones, as a frame."""
    if sets is None:
        sets = [{"candidate_set_id": i, **p} for i, _, k, p in fv.STATIC_CANDIDATE_SETS if k == kind]
    schema = _SET_SCHEMA[kind]
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(s[n] for n in names) for s in sets], schema)


def _days_ago(as_of, days: Column) -> Column:
    return as_timestamp(as_of) - F.make_dt_interval(days)


def _item_columns(time_col: str) -> list:
    return [
        F.col("approved_corpus_item_external_id").alias("id"),
        "topic",
        "publisher",
        F.col(time_col).alias("recency"),
    ]


def _plain(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_syndicated") & ~F.col("is_collection"))


def _reviewed_items(approved: DataFrame) -> DataFrame:
    kept = _plain(approved.filter(F.col("corpus_review_status") == fv.REVIEW_STATUS))
    return kept.select(*_item_columns("reviewed_corpus_item_updated_at"), "scheduled_surface_id")


def _manually_scheduled_items(scheduled: DataFrame) -> DataFrame:
    kept = _plain(scheduled.filter(F.col("corpus_item_loaded_from") == fv.LOADED_MANUALLY))
    return kept.select(*_item_columns("scheduled_corpus_item_scheduled_at"), "scheduled_surface_id")


def _not_excluded(column: str = "id") -> Column:
    return F.col(column) != fv.EXCLUDED_ITEM_ID


def collections_by_recency(approved: DataFrame, scheduled: DataFrame, as_of, sets=None) -> DataFrame:
    """Recommended collections by the time they were scheduled, or else created."""
    params = static_sets(approved.sparkSession, "collections_by_recency", sets)
    now = as_timestamp(as_of)
    # Of several schedules only the last can be the recency, so one row per (item,
    # surface) is enough for the join.
    last_schedule = (
        scheduled.filter(F.col("scheduled_corpus_item_scheduled_at") < now)
        .groupBy(F.col("approved_corpus_item_external_id").alias("id"), "scheduled_surface_id")
        .agg(F.max("scheduled_corpus_item_scheduled_at").alias("scheduled_at"))
    )
    collections = approved.filter(
        F.col("is_collection")
        & (F.col("corpus_review_status") == fv.REVIEW_STATUS)
        & _not_excluded("approved_corpus_item_external_id")
    ).select(*_item_columns("reviewed_corpus_item_created_at"), "language")
    in_sets = collections.join(params, "language", "inner")
    dated = in_sets.join(last_schedule, ["id", "scheduled_surface_id"], "left").withColumn(
        "recency", F.coalesce("scheduled_at", "recency")
    )
    recent = dated.filter(F.col("recency").between(_days_ago(as_of, -F.col("max_age_days")), now))
    return latest_per_key(recent, _ID_AND_SET, "recency", _TIES).select(*_OUTPUT)


def life_hacks(
    approved: DataFrame, scheduled: DataFrame, as_of, topics: Sequence[str] = tuple(fv.LIFE_HACK_TOPICS), sets=None
) -> DataFrame:
    """Reviewed or manually scheduled items of some topics."""
    params = static_sets(approved.sparkSession, "life_hacks", sets)
    past = _manually_scheduled_items(scheduled).filter(F.col("recency") < as_timestamp(as_of))
    items = concat_frames(past, _reviewed_items(approved)).filter(F.col("topic").isin(list(topics)) & _not_excluded())
    today = F.date_trunc("day", as_timestamp(as_of))
    in_sets = items.join(params, "scheduled_surface_id", "inner").filter(
        F.col("recency") >= today - F.make_dt_interval("max_age_days")
    )
    return latest_per_key(in_sets, _ID_AND_SET, "recency", _TIES).select(*_OUTPUT)


def daily_hits(scheduled: DataFrame, as_of, sets=None) -> DataFrame:
    """The eight newest items whose scheduled day has reached seven o'clock UTC."""
    params = static_sets(scheduled.sparkSession, "daily_hits", sets)
    opened = F.date_trunc("day", "scheduled_corpus_item_scheduled_at") + F.expr(
        f"INTERVAL {fv.DAILY_HITS_HOUR_UTC} HOURS"
    )
    items = scheduled.filter((opened < as_timestamp(as_of)) & _not_excluded("approved_corpus_item_external_id"))
    in_sets = items.select(
        *_item_columns("scheduled_corpus_item_scheduled_at"), "scheduled_surface_id"
    ).join(params, "scheduled_surface_id", "inner")
    latest = latest_per_key(in_sets, _ID_AND_SET, "recency", _TIES)
    newest = [F.desc("recency"), F.asc("id")]
    return top_n_per_group(latest, "candidate_set_id", newest, fv.DAILY_HITS_COUNT).select(*_OUTPUT)


def scheduled_items(scheduled: DataFrame, as_of, sets=None) -> DataFrame:
    """Plain items scheduled from some days ago up to today's midnight."""
    params = static_sets(scheduled.sparkSession, "scheduled_items", sets)
    today = F.date_trunc("day", as_timestamp(as_of))
    items = _plain(scheduled.filter(_not_excluded("approved_corpus_item_external_id")))
    in_sets = (
        items.select(*_item_columns("scheduled_corpus_item_scheduled_at"), "scheduled_surface_id")
        .join(params, "scheduled_surface_id", "inner")
        .filter(F.col("recency").between(today - F.make_dt_interval(-F.col("max_age_days")), today))
    )
    return latest_per_key(in_sets, _ID_AND_SET, "recency", _TIES).select(*_OUTPUT)


def recommended_by_recency(approved: DataFrame, scheduled: DataFrame, as_of, sets=None) -> DataFrame:
    """The newest items of each topic.

    The excluded item is dropped among the reviewed items only. A reviewed item
    without time of review counts as the newest.
    """
    spark = approved.sparkSession
    params = static_sets(spark, "recommended_by_recency", sets)
    # a Python constant, so that Spark can limit the groups before it shuffles them
    most = max((p["n_per_topic"] for p in sets), default=0) if sets is not None else max(
        p["n_per_topic"] for _, _, k, p in fv.STATIC_CANDIDATE_SETS if k == "recommended_by_recency"
    )
    past = _manually_scheduled_items(scheduled).filter(F.col("recency") < as_timestamp(as_of))
    items = concat_frames(past, _reviewed_items(approved).filter(_not_excluded()))
    in_sets = items.join(params, "scheduled_surface_id", "inner")
    latest = latest_per_key(in_sets, _ID_AND_SET, "recency", _TIES, nulls_first=True)
    newest = [F.desc_nulls_first("recency"), F.asc("id")]
    ranked = top_n_per_group(latest, ["candidate_set_id", "topic"], newest, most)
    if sets is not None and len({p["n_per_topic"] for p in sets}) > 1:
        rank = F.row_number().over(Window.partitionBy("candidate_set_id", "topic").orderBy(*newest))
        ranked = ranked.withColumn("_n", rank).filter(F.col("_n") <= F.col("n_per_topic"))
    return ranked.select(*_OUTPUT)


def topic_items(approved: DataFrame, scheduled: DataFrame, as_of, sets: DataFrame) -> DataFrame:
    """Items of a topic from the last 90 days, one set per (topic, surface) of ``sets``.

    The union needs no duplicate removal of its own: one row per item is kept anyway.
    """
    now = as_timestamp(as_of)
    since = now - F.expr(f"INTERVAL {fv.TOPIC_MAX_AGE_DAYS} DAYS")
    items = concat_frames(
        _reviewed_items(approved).filter(F.col("recency") >= since),
        _manually_scheduled_items(scheduled).filter(F.col("recency").between(since, now)),
    ).filter(_not_excluded())
    params = sets.select("candidate_set_id", "topic", "scheduled_surface_id")
    in_sets = items.join(params, ["topic", "scheduled_surface_id"], "inner")
    return latest_per_key(in_sets, _ID_AND_SET, "recency", _TIES).select(*_OUTPUT)


def topic_sets(topics: DataFrame) -> DataFrame:
    """Two sets per topic, one for each surface."""
    surfaces = [
        ("curated_catalog_candidate_set_id", "en_us/", fv.SURFACE_EN_US),
        ("german_curated_catalog_candidate_set_id", "de_de/", fv.SURFACE_DE_DE),
    ]
    entries = [
        F.struct(
            F.col(id_col).alias("candidate_set_id"),
            F.concat(F.lit(prefix), F.lower("corpus_topic_id")).alias("name"),
            F.lit("topic_items").alias("kind"),
            F.col("corpus_topic_id").alias("topic"),
            F.lit(surface).alias("scheduled_surface_id"),
        )
        for id_col, prefix, surface in surfaces
    ]
    return topics.select(F.inline(F.array(*entries)))


def candidate_configs(topics: DataFrame) -> DataFrame:
    """All sets: the fixed ones and two per topic, with the least number of items."""
    rows = [
        (set_id, name, kind, None, params["scheduled_surface_id"])
        for set_id, name, kind, params in fv.STATIC_CANDIDATE_SETS
    ]
    schema = "candidate_set_id string, name string, kind string, topic string, scheduled_surface_id string"
    static = topics.sparkSession.createDataFrame(rows, schema)
    everything = concat_frames(static, topic_sets(topics))
    least = F.when(F.col("name").contains(fv.MAY_BE_EMPTY), 0).otherwise(1)
    return everything.withColumn("min_item_count", least)


def candidate_items(approved: DataFrame, scheduled: DataFrame, topics: DataFrame, as_of) -> DataFrame:
    """Items of all sets."""
    return concat_frames(
        collections_by_recency(approved, scheduled, as_of),
        life_hacks(approved, scheduled, as_of),
        daily_hits(scheduled, as_of),
        scheduled_items(scheduled, as_of),
        recommended_by_recency(approved, scheduled, as_of),
        topic_items(approved, scheduled, as_of, topic_sets(topics)),
    )


def all_candidate_sets(
    approved: DataFrame, scheduled: DataFrame, topics: DataFrame, as_of, max_items: int | None = None
) -> DataFrame:
    """One JSON message per set (a set above ``max_items``, if given, fails the job).

    The job fails on an item without id or topic, and on a set with too few items.
    """
    items = candidate_items(approved, scheduled, topics, as_of)
    bad = F.col("id").isNull() | (F.col("id") == "") | F.col("topic").isNull() | (F.col("topic") == "")
    checked_id = F.when(
        bad, F.raise_error(F.concat(F.lit("invalid item in candidate set "), "candidate_set_id"))
    ).otherwise(F.col("id"))
    item = F.struct(checked_id.alias("ID"), F.col("topic").alias("TOPIC"), F.col("publisher").alias("PUBLISHER"))
    order = [F.desc_nulls_first("recency"), F.asc("id")]
    messages = item_messages(items, "candidate_set_id", order, ["id"], item, max_items)
    joined = candidate_configs(topics).join(messages, "candidate_set_id", "left")
    count = F.coalesce("row_count", F.lit(0))
    too_few = F.when(
        count < F.col("min_item_count"), F.raise_error(F.concat(F.lit("too few items in "), "name"))
    ).otherwise(count)
    return joined.select(
        F.col("candidate_set_id").alias("id"),
        "name",
        F.coalesce("chunk_no", F.lit(0)).alias("chunk_no"),
        too_few.cast("bigint").alias("item_count"),
        iso8601(as_timestamp(as_of)).alias("unloaded_at"),
        F.coalesce("items_json", F.lit("[]")).alias("corpus_items"),
    )
