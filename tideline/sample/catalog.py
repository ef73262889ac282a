"""Every operator and pipeline as a query over the given tables.

A query takes (spark, folder of the tables) and returns a DataFrame whose columns
have the names, and whose dates and times the text form, of the SQL in
:mod:`tideline.sample.oracle`.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, iso8601, parse_iso8601
from ..functions.text import html_to_text
from ..operators import checks, chunks, counting, intervals, latest, setops, sketches, tables, unnest
from ..plans import articles, backend_events, candidates, engagement, feeds, legacy_candidates, publisher
from ..plans import retention, revenue, runner, score, telemetry_legacy, telemetry_nested, user_sync
from ..session import materialized, scratch, shared_dir, shuffles_removed
from ..sources import files, records
from ..sources.logs import OffsetLog
from ..sources import tables as table_io
from ..streaming import streams
from .rules import AS_OF, OWN_DOMAIN, SPARK, view_columns
from .spark_views import Views

START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
ROLLING_AS_OF = "2024-01-30 12:00:00"
TRAILING_AS_OF = "2024-01-30 23:00:00"
COLLECTED_UNTIL = "2024-01-30 06:00:00"
TIE = "event_id"

_QUERIES: dict[str, Callable[[Views], DataFrame]] = {}


def _query(function: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    _QUERIES[function.__name__] = function
    return function


def _comparable(df: DataFrame) -> DataFrame:
    """Dates, times and decimals in a form every client reads alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.DecimalType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function):
        return lambda spark, sf_dir: _comparable(function(Views(spark, sf_dir)))

    return {name: bound(function) for name, function in _QUERIES.items()}


# --- telemetry, legacy pings -------------------------------------------------------
@_query
def daily_disable_rate_legacy(v):
    return telemetry_legacy.daily_disable_rate_legacy(v.legacy_pings(), START, END, TIE)


@_query
def daily_unique_engagement_legacy(v):
    return telemetry_legacy.daily_unique_engagement_legacy(v.legacy_pings(), v.spoc_tiles(), START, END, TIE)


@_query
def monthly_unique_engagement_legacy(v):
    return telemetry_legacy.monthly_unique_engagement_legacy(
        v.legacy_pings(), v.spoc_tiles(), "2024-01-30 00:00:00", END, TIE
    )


@_query
def daily_spoc_fill_rate_legacy(v):
    return telemetry_legacy.daily_spoc_fill_rate_legacy(v.legacy_pings(), v.spoc_tiles(), START, END, TIE)


@_query
def engagement_by_tile_position_legacy(v):
    return telemetry_legacy.engagement_by_tile_position_legacy(v.legacy_pings(), ROLLING_AS_OF, TIE)


@_query
def engagement_by_tile_position_locale_legacy(v):
    return telemetry_legacy.engagement_by_tile_position_locale_legacy(v.legacy_pings(), ROLLING_AS_OF, TIE)


@_query
def trailing_engagement_activity_stream(v):
    return telemetry_legacy.trailing_engagement_activity_stream(v.legacy_pings(), TRAILING_AS_OF)


# --- telemetry, nested pings -------------------------------------------------------
@_query
def daily_disable_rate_nested(v):
    return telemetry_nested.daily_disable_rate_nested(v.nested_pings(), START, END, TIE)


@_query
def daily_unique_engagement_nested(v):
    return telemetry_nested.daily_unique_engagement_nested(v.nested_pings(), START, END, TIE)


@_query
def daily_spoc_fill_rate_nested(v):
    return telemetry_nested.daily_spoc_fill_rate_nested(v.nested_pings(), START, END, TIE)


@_query
def engagement_by_tile_position_nested(v):
    return telemetry_nested.engagement_by_tile_position_nested(v.nested_pings(), ROLLING_AS_OF, TIE)


@_query
def engagement_by_tile_position_locale_nested(v):
    return telemetry_nested.engagement_by_tile_position_locale_nested(v.nested_pings(), ROLLING_AS_OF, TIE)


_USER_EVENTS = (
    "submission_timestamp timestamp, document_id string, event_name string, recommendation_id string, "
    "_loaded_at timestamp"
)


def _user_events(v: Views) -> DataFrame:
    """Rows collected up to some hour, and the rows a later run appends to them."""
    pings = v.nested_pings()
    empty = v.spark.createDataFrame([], _USER_EVENTS)
    early = pings.filter(F.col("submission_timestamp") <= as_timestamp(COLLECTED_UNTIL))
    collected = telemetry_nested.new_user_events(early, empty, TRAILING_AS_OF)
    appended = telemetry_nested.new_user_events(pings, collected, TRAILING_AS_OF)
    return setops.concat_frames(collected, appended)


@_query
def new_user_events(v):
    return _user_events(v).drop("_loaded_at")


@_query
def trailing_engagement_nested_exact(v):
    return telemetry_nested.trailing_engagement_nested(_user_events(v), TRAILING_AS_OF, exact=True)


@_query
def trailing_engagement_nested_approx(v):
    return telemetry_nested.trailing_engagement_nested(_user_events(v), TRAILING_AS_OF)


@_query
def trailing_engagement_nested_error(v):
    """Exact counts, and whether those from the sketches lie within three standard errors."""
    events = _user_events(v)
    exact = telemetry_nested.trailing_engagement_nested(events, TRAILING_AS_OF, exact=True)
    names = ["trailing_1_day_impressions", "trailing_1_day_opens"]
    estimates = telemetry_nested.trailing_engagement_nested(events, TRAILING_AS_OF)
    estimates = estimates.select("corpus_recommendation_id", *[F.col(n).alias(f"_{n}") for n in names])
    close = [sketches.within_error(F.col(f"_{n}"), F.col(n)).alias(f"{n}_close") for n in names]
    return exact.join(estimates, "corpus_recommendation_id", "full").select("corpus_recommendation_id", "updated_at", *names, *close)


@_query
def aggregate_engagement(v):
    nested = telemetry_nested.trailing_engagement_nested(_user_events(v), TRAILING_AS_OF, exact=True)
    legacy = telemetry_legacy.trailing_engagement_activity_stream(v.legacy_pings(), TRAILING_AS_OF)
    return engagement.aggregate_engagement(nested, legacy, v.plain("recommendations"), TRAILING_AS_OF)


# --- events, feeds, features -------------------------------------------------------
@_query
def backend_events_export(v):
    return backend_events.backend_events(v.plain("backend_raw"), START, END)


def _feed_round_trip(v: Views, name: str) -> DataFrame:
    folder = shared_dir(v.spark, name)
    feeds.export_table(v.plain(name), name, folder, zone="America/New_York")
    return feeds.load_table(v.spark, name, folder, AS_OF).withColumnRenamed(fv.LOADED_AT_COLUMN, "loaded_at")


@_query
def curated_feed_items_refresh(v):
    return _feed_round_trip(v, "curated_feed_items")


@_query
def curated_feed_deleted_refresh(v):
    return _feed_round_trip(v, "curated_feed_items_deleted")


@_query
def curated_feed_prospects_refresh(v):
    return _feed_round_trip(v, "curated_feed_prospects")


@_query
def curated_feed_queued_refresh(v):
    return _feed_round_trip(v, "curated_feed_queued_items")


@_query
def tile_source_refresh(v):
    return _feed_round_trip(v, "tile_source")


@_query
def publisher_features(v):
    result = publisher.publisher_features(
        v.plain("content"), v.plain("engagement_by_day"), v.approved(), v.plain("scheduled_content"), AS_OF, [OWN_DOMAIN]
    )
    return result.withColumns({c: F.round(c, 6) for c in ("avg_save_age", "avg_save_count", "log_total_saves")})


@_query
def user_impressions(v):
    return engagement.user_impressions(v.plain("impressions"), v.plain("recommendations"), AS_OF)


@_query
def corpus_item_engagement(v):
    return engagement.corpus_item_engagement(v.plain("trailing_by_item"))


# --- revenue -----------------------------------------------------------------------
def _order_lines(v: Views) -> DataFrame:
    """Order lines, one row per matching order, with the columns that revenue records are made of."""
    orders, lines = v.table("orders"), v.table("lineitem")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "o_orderdate"
    )


def _revenue_texts(prefix: str, lacking: tuple = ()) -> dict:
    """The prefixed texts of a line with its ``day``, some of them lacking."""
    values = {
        "record_date": F.date_format("day", "yyyy-MM-dd"),
        "network": F.col("l_returnflag"),
        "url": F.concat(F.lit("https://"), "l_linestatus", F.lit(".example")),
        "ad_unit": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "size": F.when(F.col("l_linenumber") % 2 == 0, F.lit("300x250")),
        "impressions": F.col("l_quantity").cast("bigint").cast("string"),
        "net_revenue": F.col("l_orderkey").cast("string"),
        "net_cpm": F.format_string("%.2f", "l_discount"),
    }
    return {f"{prefix}.{name}": value for name, value in values.items() if name not in lacking}


def _revenue_records(lines: DataFrame) -> DataFrame:
    """Each line as a map of prefixed texts."""
    pairs = [part for name, value in _revenue_texts(fv.REVENUE_PREFIX).items() for part in (F.lit(name), value)]
    return lines.select(F.create_map(*pairs).alias("record"), "l_orderkey")


def _revenue_pages(v: Views) -> DataFrame:
    """Landed pages of the order lines, by ranges of the orders."""
    numbered = _revenue_records(_order_lines(v).withColumnRenamed("o_orderdate", "day"))
    pages = numbered.groupBy(F.floor(F.col("l_orderkey") / 100).alias("page_key"))
    return pages.agg(F.collect_list("record").alias("data")).select("data")


@_query
def revenue_page_rows(v):
    return revenue.revenue_rows(_revenue_pages(v))


#: The days the order lines are dealt to; the first half lands as archived pages.
_LANDED_FIRST, _LANDED_DAYS = "1998-02-20", 28


@_query
def revenue_load(v):
    """All order lines, landed as gzipped pages of 5,000 records in a folder per day, a file per page; the table had every third day.

    The days the table lacks are loaded, the archived ones (without two dimensions) by a
    load of their own; the days it had stay as they were. The joined lines are written
    once, and a line's texts are made only where its page is written: no shuffle moves a
    text or a key. What is written or shuffled on the way is removed as soon as the pages
    made of it have landed.
    """
    root = shared_dir(v.spark, "revenue-load")
    offset = (F.col("l_orderkey") % _LANDED_DAYS).cast("int")
    day = F.date_add(F.lit(_LANDED_FIRST).cast("date"), offset)
    half = F.date_add(F.lit(_LANDED_FIRST).cast("date"), _LANDED_DAYS // 2)
    held = F.date_diff("day", F.lit(_LANDED_FIRST)) % 3 == 0
    table = revenue.revenue_table(v.spark, f"{root}/table")
    with scratch(v.spark):
        lines = materialized(_order_lines(v).drop("o_orderdate").withColumn("day", day), "order-lines")
        had = _revenue_records(lines.filter(held)).select(F.array("record").alias("data"))
        table.replace(revenue.revenue_rows(had).withColumn("impressions", -F.col("impressions")))
        for name, prefix, lacking, part in (
            ("archived", fv.REVENUE_PREFIX_ARCHIVED, ("url", "size"), F.col("day") < half),
            ("current", fv.REVENUE_PREFIX, (), F.col("day") >= half),
        ):
            with scratch(v.spark), shuffles_removed(v.spark):
                numbered = chunks.chunk_rows(lines.filter(part), 5000, ["day"], [F.asc("l_orderkey")], ["l_linenumber"])
                dealt = numbered.drop("row_no").repartition("day", "chunk_no")
                record = F.struct(*[value.alias(name) for name, value in _revenue_texts(prefix, lacking).items()])
                pages = dealt.groupBy("day", "chunk_no").agg(F.collect_list(record).alias("data")).drop("chunk_no")
                pages.write.option("maxRecordsPerFile", 1).option("compression", "gzip").partitionBy("day").json(f"{root}/{name}")
    window = ("1998-02-20 00:00:00", "1998-03-05 00:00:00")
    now = "1998-03-20 00:00:00"
    revenue.load_missing_days(v.spark, table, lambda d: f"{root}/archived/day={d}", now, *window, archived=True)
    return revenue.load_missing_days(v.spark, table, lambda d: f"{root}/current/day={d}", now)


@_query
def revenue_days_without_rows(v):
    """Days on which a load would have to fail: every fifth day of a month lands nothing."""
    rows = revenue.revenue_rows(_revenue_pages(v)).filter(F.dayofmonth("record_date") % 5 != 0)
    return revenue.days_without_rows(intervals.day_spine(v.spark, "1995-01-01", "1998-08-02"), rows)


@_query
def revenue_key_replace(v):
    """Days from mid-1998 on are loaded again; the table held other rows for some of them."""
    rows = revenue.revenue_rows(_revenue_pages(v)).select("record_date", "network", "ad_unit", "impressions")
    batch = rows.filter(F.col("record_date") >= F.lit("1998-06-01").cast("date"))
    held = rows.filter(F.month("record_date") != 7).withColumn("impressions", -F.col("impressions"))
    return revenue.revenue_key_replace(held, batch)


@_query
def revenue_days_to_load(v):
    held = v.table("orders").select(F.to_date("o_orderdate").alias("record_date"))
    return revenue.days_to_load(held.filter(F.dayofmonth("record_date") % 3 != 0), "1998-03-20 00:00:00")


@_query
def missing_days(v):
    held = v.table("orders").select(F.col("o_orderdate").alias("record_date"))
    odd = held.filter(F.dayofmonth("record_date") % 2 == 1)
    return intervals.missing_days(odd, "record_date", AS_OF, "1995-01-01 00:00:00", "2001-08-01 00:00:00")


# --- scores ------------------------------------------------------------------------
@_query
def content_score_inputs(v):
    inputs = score.content_score_inputs(v.score_queue(), v.lifetime(), limit=None)
    return inputs.withColumns({c: F.round(c, 6) for c in inputs.columns if c.endswith(("_uv", "_dv"))})


@_query
def content_score(v):
    inputs = score.content_score_inputs(v.score_queue(), v.lifetime(), limit=None)
    return score.content_score(inputs).withColumns({c: F.round(c, 4) for c in score.RESULT if c.endswith("_score")})


@_query
def content_score_queue_left(v):
    """Keys that stay in the queue, with the score table each scored key went to."""
    queue = v.score_queue()
    inputs = score.content_score_inputs(queue, v.lifetime(), limit=None).select("publisher_id", "content_id")
    left = setops.without_match(queue, inputs, score.KEYS).withColumn("target", F.lit("queue"))
    is_small = F.col("content_id") <= fv.SCORE_MAX_SMALL_ID
    routed = inputs.withColumn("target", F.when(is_small, "small").otherwise("large"))
    return setops.concat_frames(left, routed)


# --- candidate sets ----------------------------------------------------------------
def _iso_recency(df: DataFrame) -> DataFrame:
    return df.withColumn("recency", F.date_format("recency", "yyyy-MM-dd HH:mm:ss"))


@_query
def collections_by_recency(v):
    return _iso_recency(candidates.collections_by_recency(v.approved(), v.scheduled(), AS_OF))


@_query
def life_hacks(v):
    return _iso_recency(candidates.life_hacks(v.approved(), v.scheduled(), AS_OF))


@_query
def daily_hits(v):
    return _iso_recency(candidates.daily_hits(v.scheduled(), AS_OF))


@_query
def recommended_by_recency(v):
    return _iso_recency(candidates.recommended_by_recency(v.approved(), v.scheduled(), AS_OF))


@_query
def scheduled_items(v):
    return _iso_recency(candidates.scheduled_items(v.scheduled(), AS_OF))


@_query
def topic_items(v):
    sets = candidates.topic_sets(v.topics())
    return _iso_recency(candidates.topic_items(v.approved(), v.scheduled(), AS_OF, sets))


@_query
def candidate_configs(v):
    return candidates.candidate_configs(v.topics()).withColumn("topic", F.coalesce("topic", F.lit("")))


@_query
def candidate_set_json(v):
    return candidates.all_candidate_sets(v.approved(), v.scheduled(), v.topics(), AS_OF).drop("chunk_no")


@_query
def legacy_longreads(v):
    return _iso_recency(legacy_candidates.longreads(v.approved(), v.plain("content"), AS_OF))


@_query
def legacy_shortreads(v):
    return _iso_recency(legacy_candidates.shortreads(v.approved(), v.plain("content"), AS_OF))


@_query
def legacy_curated_feeds(v):
    return _iso_recency(legacy_candidates.curated_feeds(v.scheduled(), v.plain("content"), AS_OF))


@_query
def legacy_syndicated(v):
    return _iso_recency(legacy_candidates.syndicated_feed(v.scheduled(), v.plain("syndicated_articles"), AS_OF))


@_query
def legacy_topics(v):
    return _iso_recency(legacy_candidates.legacy_topics(v.approved(), v.plain("content"), v.topics(), AS_OF))


@_query
def legacy_candidate_messages(v):
    """Messages of all items; those whose domain has no name get one, as the messages must name a publisher."""
    items = legacy_candidates.shortreads(v.approved(), v.plain("content"), AS_OF).na.fill("unknown", ["publisher"])
    order = [F.desc("recency"), F.asc("id"), F.asc("publisher")]
    messages = records.candidate_messages(items, order, ["id"], "shortreads", "run-1", 1706659200, curated=True)
    return messages.select("candidate_set_id", "row_count", "message")


@_query
def legacy_item_violations(v):
    """Sets with an item that names no publisher, and one that has no items at all."""
    items = legacy_candidates.shortreads(v.approved(), v.plain("content"), AS_OF)
    empty = v.spark.createDataFrame([("no-such-set",)], "candidate_set_id string")
    sets = items.select("candidate_set_id").distinct().unionByName(empty)
    return checks.legacy_item_violations(items, sets, "candidate_set_id")


# --- user sync ---------------------------------------------------------------------
def _deltas(v: Views, production: bool = True) -> DataFrame:
    return user_sync.clean_deltas(v.plain("user_changes"), "2024-01-10 00:00:00", production)


@_query
def user_deltas(v):
    return _deltas(v)


@_query
def user_deltas_masked(v):
    return _deltas(v, production=False).select("event_id", "external_id", "email", "has_email")


@_query
def user_delta_offset(v):
    latest_load = user_sync.new_offset(_deltas(v))
    return latest_load.select(F.col("last_offset").cast("timestamp").alias("last_offset"))


def _items(v: Views, step: int) -> DataFrame:
    """Items of a step."""
    items = user_sync.delta_items(_deltas(v))
    return items.filter(F.col("step") == step)


@_query
def alias_rows(v):
    return _items(v, 1).select("event_id", "endpoint", "main")


@_query
def identify_rows(v):
    return _items(v, 2).select("event_id", "endpoint", "main")


@_query
def subscribe_rows(v):
    return _items(v, 3).select("event_id", "subscription_group_id", "main", "extra")


@_query
def track_rows(v):
    return _items(v, 4).select("event_id", F.col("main").alias("attributes"), F.col("extra").alias("event"))


@_query
def delete_rows(v):
    return _items(v, 5).select("event_id", "main")


@_query
def user_delta_payloads(v):
    payloads = user_sync.user_delta_payloads(_deltas(v))
    return payloads.select(
        "step", "endpoint", "subscription_group_id", "chunk_no", "row_count", F.md5("payload").alias("payload_md5")
    )


# --- retention -----------------------------------------------------------------------
@_query
def new_deleted_users(v):
    return retention.new_deleted_users(v.deleted_users(), v.known_users())


@_query
def new_deleted_emails(v):
    return retention.new_deleted_emails(v.plain("email_map"), v.deleted_users(), v.known_emails())


@_query
def purge_plain_key(v):
    return tables.purge(v.plain("user_orders"), v.deleted_users(), [("user_id", "user_id")])


@_query
def purge_json_key(v):
    own = F.get_json_object("event", "$.data.user_id")
    return tables.purge(v.plain("event_payloads"), v.deleted_users(), [(own, "user_id")]).drop("event")


@_query
def purge_two_keys(v):
    pairs = [("user_id", "user_id"), ("hashed_user_id", "hashed_user_id")]
    return tables.purge(v.plain("user_orders"), v.deleted_users(), pairs)


@_query
def purge_extra_predicate(v):
    rule = retention.Rule((("$.data.user_key", "user_id"),), only_if=("$.data.user_key_type_id", 1))
    purged = retention.purge_table(v.plain("event_payloads"), rule, retention.account_keys(v.deleted_users(), v.known_emails()))
    return purged.drop("event")


@_query
def purge_flag(v):
    return tables.purge_flagged(v.plain("user_orders"), "is_deleted")


@_query
def purge_deleted_accounts(v):
    """All steps, with a table for every kind of rule; the result lists what is left of each."""
    orders, payloads = v.plain("user_orders"), v.plain("event_payloads")
    user, hashed, email = (("user_id",) * 2, ("hashed_user_id",) * 2, ("email",) * 2)
    rules = {
        "orders_by_user": (orders, retention.Rule((user,))),
        "orders_by_hash_or_user": (orders, retention.Rule((hashed, user))),
        "orders_by_email": (orders, retention.Rule((email,))),
        "orders_by_user_or_email": (orders, retention.Rule((user, email))),
        "payloads_by_user": (payloads, retention.Rule((("$.data.user_id", "user_id"),))),
        "payloads_of_one_type": (
            payloads, retention.Rule((("$.data.user_key", "user_id"),), only_if=("$.data.user_key_type_id", 1))),
        "events_by_context": (
            v.plain("context_events"),
            retention.Rule((("$[0].hashed_user_id", "hashed_user_id"), ("$[0].user_id", "user_id")), payload="context")),
    }
    result = retention.purge_deleted_accounts(
        {name: table for name, (table, _) in rules.items()} | {"orders_flagged": orders},
        {name: rule for name, (_, rule) in rules.items()},
        {"orders_flagged": "is_deleted"},
        v.deleted_users(),
        v.plain("email_map"),
        v.known_users(),
        v.known_emails(),
    )
    key = {"deleted_users": "hashed_user_id", "deleted_emails": "email"}
    key |= {name: "event_id" for name in ("payloads_by_user", "payloads_of_one_type", "events_by_context")}
    parts = [
        table.select(F.lit(name).alias("table_name"), F.col(key.get(name, "o_orderkey")).cast("string").alias("row_key"))
        for name, table in result.items()
    ]
    return setops.concat_frames(*parts)


# --- incremental load and table maintenance --------------------------------------------
@_query
def interval_plan(v):
    """The plan from the first event on, up to the last."""
    bounds = v.table("events").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    first, last = (bounds.select(F.col(c).cast("timestamp")).scalar() for c in ("a", "b"))
    return intervals.interval_plan(v.spark, first, end=last)


@_query
def tag_batches(v):
    plan = intervals.interval_plan(v.spark, "2024-01-05 13:30:00", "2024-01-20 08:00:00", include_now=True)
    events = v.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return intervals.tag_batches(events, "ts", plan).drop("ts")


@_query
def stale_partitions(v):
    """Staged files named after the events' times; a re-run starts in the afternoon of day 10."""
    date, time = intervals.folder_names(F.col("ts").cast("timestamp"))
    path = F.concat(F.lit("gs://stage/job/date="), date, F.lit("/time="), time, F.lit("/data.parquet"))
    paths = v.table("events").select(path.alias("path"))
    return intervals.stale_partitions(
        paths, "2024-01-10 15:00:00", "2024-01-11 00:00:00", "2024-01-20 06:00:00"
    )


def _orders_by_day(v: Views) -> DataFrame:
    return v.table("orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.lit("new").alias("state")
    )


@_query
def range_replace(v):
    rows = _orders_by_day(v)
    batch = rows.filter(F.col("day") >= F.lit("2000-03-01").cast("date")).filter("o_orderkey % 2 = 0")
    target = rows.withColumn("state", F.lit("old")).withColumn(
        "day", F.when(F.col("o_orderkey") % 11 != 0, F.col("day"))
    )
    return tables.range_replace(target, batch, "day", ["o_orderkey"])


@_query
def key_replace(v):
    rows = _orders_by_day(v)
    batch = rows.filter(F.dayofmonth("day") <= 10).filter("o_orderkey % 2 = 0")
    return tables.key_replace(rows.withColumn("state", F.lit("old")), batch, "day")


@_query
def append_newer(v):
    rows = v.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    target = rows.filter("event_type = 'view' AND ts < TIMESTAMP '2024-01-12 12:00:00'")
    return tables.newer_than_target(rows, target, "ts", START)


@_query
def upsert_offsets(v):
    """Offsets per customer segment and nation, upserted by a later batch."""
    customers = v.table("customer")
    name = F.concat_ws("/", "c_mktsegment", "c_nationkey")
    state = customers.filter("c_nationkey < 15").groupBy(name.alias("sql_folder_name")).agg(
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
        F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
        F.min("c_custkey").cast("string").alias("last_offset"),
    )
    batch = customers.filter("c_nationkey >= 10").groupBy(name.alias("sql_folder_name")).agg(
        F.lit("2024-01-31").cast("timestamp").alias("created_at"),
        F.lit("2024-01-31").cast("timestamp").alias("updated_at"),
        F.max("c_custkey").cast("string").alias("last_offset"),
    )
    return tables.upsert(state, batch, ["sql_folder_name"], ["updated_at", "last_offset"], ["created_at"])


def _article_rows(v: Views) -> DataFrame:
    """Pages as articles; every fifth arrived a second time, later."""
    pages = v.table("pages")
    first = pages.select(
        F.col("page_id").alias("resolved_id"), F.length("html").alias("size"),
        F.md5("html").alias("text_md5"), as_timestamp("2024-01-01 00:00:00").alias("loaded_at"),
    )
    again = first.filter("resolved_id % 5 = 0").withColumns(
        {"loaded_at": as_timestamp("2024-01-02 00:00:00"), "size": F.col("size") + 1}
    )
    return first.unionByName(again)


@_query
def compact_latest(v):
    return tables.clustered(
        tables.compact_latest(_article_rows(v), "resolved_id", "loaded_at", AS_OF, ["text_md5"]), "resolved_id"
    )


@_query
def versioned_table_swap(v):
    """Write, replace and read a table through its versions."""
    table = table_io.DayTable(v.spark, shared_dir(v.spark, "versions"), "loaded_at")
    table.replace(_article_rows(v))
    table.replace(tables.compact_latest(table.read(), "resolved_id", "loaded_at", AS_OF, ["text_md5"]), "all")
    return table.read().drop("last_ordered")


def _daily_counts(v: Views, state: str, **options) -> runner.Job:
    """Events per day and type; ``state`` tells runs apart."""
    events = v.table("events").select(F.col("ts").cast("timestamp").alias("t"), "event_type")

    def extract(start, end):
        rows = events.filter(intervals.in_interval("t", start, end))
        return rows.groupBy(F.to_date("t").alias("day"), "event_type").agg(F.count("*").alias("n"), F.lit(state).alias("state"))

    def new_offset(start, end):
        return events.filter(intervals.in_interval("t", start, end)).agg(F.date_format(F.max("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]

    columns = [("day", "date"), ("event_type", "string"), ("n", "bigint"), ("state", "string")]
    return runner.Job("daily_counts", extract, new_offset, columns, ["day", "n"], "day", **options)


# Where the first load ends and the daily run begins, where the backfill begins, and when it runs.
DAILY_FROM, SECOND_START, LATER = "2024-01-25 23:59:59.999999", "2024-01-27 23:59:59.999999", "2024-02-01 00:00:00"


def _incremental(v: Views, backfill: bool) -> DataFrame:
    """One load of everything up to some day, and a run that catches up day by day; then a backfill of the last days."""
    root = shared_dir(v.spark, "incremental")
    daily = _daily_counts(v, "first", initial_offset=DAILY_FROM)
    start = _daily_counts(v, "start", incremental=False)
    start.extract = lambda _, __, extract=daily.extract: extract("1970-01-01 00:00:00", "2024-01-26 00:00:00").withColumn("state", F.lit("start"))
    runner.run_incremental(v.spark, start, root, AS_OF)
    runner.run_incremental(v.spark, daily, root, AS_OF)
    if backfill:
        again = _daily_counts(v, "again", override_offset=SECOND_START, override_end=AS_OF)
        runner.run_incremental(v.spark, again, root, LATER)
    return runner.job_table(v.spark, root, daily).read().select("day", "event_type", "n", "state", "_gs_file_date")


@_query
def incremental_run(v):
    """Events counted day by day: one load of the first weeks, then a run that catches up on the days since."""
    return _incremental(v, backfill=False)


@_query
def incremental_backfill(v):
    """The same, and the last days once more by a backfill, which replaces them."""
    return _incremental(v, backfill=True)


@_query
def offset_state(v):
    """Offsets after a run over two jobs side by side, a run with nothing to do, and a backfill of one of them."""
    root = shared_dir(v.spark, "offsets")
    one, two = (_daily_counts(v, "first", initial_offset=SECOND_START) for _ in range(2))
    one.name, two.name = "counts_one", "counts_two"
    parent = runner.Job("parent", lambda start, end: v.table("region").limit(0), incremental=False, sub_jobs=[one, two])
    for as_of in (AS_OF, AS_OF):
        runner.run_incremental(v.spark, parent, root, as_of)
    two.override_offset, two.override_end = SECOND_START, "2024-01-30 00:00:00"
    runner.run_incremental(v.spark, two, root, LATER)
    return runner.offset_log(v.spark, root).state()


@_query
def replace_days(v):
    """Day folders replaced in place, later days dropped."""
    folder = shared_dir(v.spark, "days")
    rows = v.table("events").select("event_id", F.to_date("ts").alias("day"), F.lit("old").alias("state"))
    rows.repartition("day").write.partitionBy("day").parquet(folder)
    batch = rows.filter("day BETWEEN DATE'2024-01-20' AND DATE'2024-01-24'").withColumn("state", F.lit("new"))
    table_io.replace_days(v.spark, batch.repartition("day"), folder, "day", open_ended=True)
    return v.spark.read.parquet(folder)


@_query
def staged_export_load(v):
    """Two batches exported, one of them twice, and loaded with lineage."""
    folder = shared_dir(v.spark, "stage")
    orders = v.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    table_io.staged_export(orders.filter("o_orderkey % 2 = 0"), folder, "2024-01-05 00:00:00")
    table_io.staged_export(orders.filter("o_orderkey % 2 = 1"), folder, "2024-01-06 12:30:00")
    table_io.staged_export(orders.filter("o_orderkey % 4 = 0"), folder, "2024-01-05 00:00:00")
    columns = [("o_orderkey", "bigint"), ("o_totalprice", "decimal(18,2)"), ("o_orderstatus", "string")]
    loaded = files.typed_load(v.spark, folder, columns, AS_OF)
    return loaded.select(
        "o_orderkey",
        F.round(F.col("o_totalprice").cast("double"), 2).alias("o_totalprice"),
        "o_orderstatus",
        F.col("_gs_file_date").alias("file_date"),
        F.col("_gs_file_time").alias("file_time"),
        (F.col("_gs_file_row_number") >= 0).alias("has_row_number"),
        F.col("_loaded_at").alias("loaded_at"),
    )


# --- articles ------------------------------------------------------------------------
@_query
def article_text(v):
    pages = v.table("pages").select(F.col("page_id").alias("resolved_id"), F.col("html").alias("article"))
    return articles.extract_article_text(pages).drop("html")


@_query
def article_objects_round_trip(v):
    """Pages written as gzip NDJSON objects, read as articles; only the conversion is left out."""
    folder = shared_dir(v.spark, "objects")
    pages = v.table("pages").select(F.col("page_id").cast("string").alias("resolved_id"), F.col("html").alias("article"))
    pages.write.option("compression", "gzip").json(folder)
    rows = files.ndjson_objects(v.spark, folder)
    return rows.select("resolved_id", F.md5("article").alias("article_md5"), F.length("article").alias("chars"))


@_query
def chunked_csv_round_trip(v):
    """Documents as gzip CSV files of at most 100 rows, loaded with a strict reader."""
    folder = shared_dir(v.spark, "csv")
    documents = v.table("documents").select("doc_id", "text", "lang")
    table_io.chunked_csv(documents, folder, rows_per_file=100)
    rows = files.header_csv(v.spark, folder, "doc_id BIGINT, text STRING, lang STRING")
    return rows.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@_query
def dead_letter_split(v):
    """Pages whose conversion fails (here: those without a closing body tag) and the others."""

    def convert(html: str) -> str:
        if "</body>" not in html:
            raise ValueError("no body")
        return html

    pages = v.table("pages").select(F.col("page_id").alias("resolved_id"), F.col("html").alias("article"))
    extracted = articles.extract_article_text(pages, convert)
    good, bad = articles.dead_letter_split(extracted, "error")
    return setops.concat_frames(
        good.select("resolved_id", F.lit("ok").alias("outcome")),
        bad.select("resolved_id", F.lit("failed").alias("outcome")),
    )


# --- single operators ------------------------------------------------------------------
@_query
def latest_per_key(v):
    orders = v.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest.latest_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey")


@_query
def earliest_per_key(v):
    orders = v.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest.latest_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey", ascending=True)


@_query
def top_n_per_group(v):
    orders = v.table("orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return latest.top_n_per_group(orders, "o_orderpriority", [F.desc("o_totalprice"), F.asc("o_orderkey")], 6)


@_query
def top_k(v):
    orders = v.table("orders").select("o_orderkey", "o_totalprice")
    return latest.top_k(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 180)


@_query
def explode_tiles(v):
    return unnest.explode_tiles(v.legacy_pings().select("event_id", "tiles"))


@_query
def explode_events(v):
    events = v.nested_pings().select("event_id", F.inline("events"))
    return unnest.explode_matching(events, "extra", "recommendation_id", "recommendation_id").drop("category")


@_query
def distinct_flag_counts(v):
    line = v.table("lineitem").select("l_returnflag", "l_linestatus", "l_suppkey", "l_quantity", "l_discount")
    return counting.distinct_flag_counts(
        line,
        ["l_returnflag", "l_linestatus"],
        "l_suppkey",
        {
            "suppliers": F.lit(True),
            "bulk_suppliers": F.col("l_quantity") >= 45,
            "discount_suppliers": F.col("l_discount") >= 0.09,
        },
    )


@_query
def sum_by_keys(v):
    rows = v.plain("trailing_by_item").withColumn(
        "corpus_item_id", F.when(F.col("corpus_item_id") != "7", F.col("corpus_item_id"))
    )
    keys = ["corpus_slate_configuration_id", "corpus_item_id"]
    return counting.sum_by_keys(rows, keys, ["trailing_1_day_impressions", "trailing_1_day_opens"])


@_query
def left_join_filtered(v):
    orders = v.table("orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    customers = v.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = setops.left_join_filtered(customers, orders, ["o_custkey"], F.col("o_orderstatus") == "F")
    return joined.drop("o_orderstatus")


@_query
def without_match(v):
    customers = v.table("customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    orders = v.table("orders").select(F.col("o_custkey").alias("custkey"))
    return setops.without_match(customers, orders.filter("custkey % 4 <> 1"), ["custkey"])


@_query
def union_distinct(v):
    first = v.plain("scheduled_once").select("topic", "publisher")
    return setops.union_distinct(first, v.plain("approved_items").select("topic", "publisher"))


@_query
def feature_records(v):
    items = engagement.corpus_item_engagement(v.plain("trailing_by_item")).select(
        "key", "updated_at", "corpus_item_id", "trailing_1_day_impressions",
        (F.col("trailing_1_day_opens") > 1).alias("seen"),
        F.when(F.col("trailing_1_day_opens") != 1, F.col("trailing_1_day_opens")).alias("maybe"),
    )
    return records.feature_records(items, "key")


@_query
def chunk_rows(v):
    """Orders of a status in chunks of 75, in order of their key."""
    orders = v.table("orders").select("o_orderstatus", "o_orderkey")
    chunked = chunks.chunk_rows(orders, 75, ["o_orderstatus"], [F.asc("o_orderkey")], ["o_orderkey"])
    return chunked.groupBy("o_orderstatus", "chunk_no").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@_query
def iso_times(v):
    """Time texts and their way back."""
    rows = v.table("events").select("event_id", iso8601(F.col("ts").cast("timestamp")).alias("iso"))
    return rows.withColumn("parsed", parse_iso8601("iso"))


# --- streaming -------------------------------------------------------------------------
def _event_stream(v: Views) -> DataFrame:
    schema = v.table("events").schema
    raw = streams.file_stream(v.spark, v.sf_dir, schema, glob="events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(stream: DataFrame, v: Views, name: str, transform=None) -> DataFrame:
    out, checkpoint = shared_dir(v.spark, name), shared_dir(v.spark, f"{name}-checkpoint")
    query = streams.write_batches(stream, out, checkpoint, transform)
    query.awaitTermination()
    return v.spark.read.parquet(out).drop("batch")


@_query
def stream_deduplicated(v):
    """One row per user and event type; which of its rows arrives first is not compared."""
    unique = streams.deduplicated_stream(_event_stream(v), "ts", ["user_id", "event_type"], late="60 days")
    return _run(unique, v, "dedup").select("user_id", "event_type")


@_query
def stream_second_clicks(v):
    """Counts per second and user over all seconds, also the last one."""
    events = _event_stream(v)
    counted = streams.second_count_stream(events, "ts", ["user_id"], F.col("event_type") == "click", late="0 seconds")
    out, checkpoint = shared_dir(v.spark, "seconds"), shared_dir(v.spark, "seconds-checkpoint")
    streams.write_batches(counted, out, checkpoint, mode="update").awaitTermination()
    return streams.without_click_spam(streams.newest_rows(v.spark, out, ["second", "user_id"]))


_SLIDE = 6 * 3600


def _trailing_stream(v: Views) -> DataFrame:
    """Days sliding by six hours over the pings' events, from the panes of a stream."""
    events = _event_stream(v).select("ts", *_as_engagement())
    panes = streams.engagement_pane_stream(events, "ts", "kind", "event_name", "document_id", "6 hours", late="0 seconds")
    out, checkpoint = shared_dir(v.spark, "trailing"), shared_dir(v.spark, "trailing-checkpoint")
    streams.write_batches(panes, out, checkpoint, mode="update").awaitTermination()
    newest = streams.newest_rows(v.spark, out, ["pane", "kind"])
    return streams.trailing_engagement(newest, "kind", slide=_SLIDE)


def _as_engagement() -> list:
    return [
        F.col("event_type").alias("kind"),
        F.when(F.col("event_type") == "click", "click").otherwise("impression").alias("event_name"),
        F.col("user_id").cast("string").alias("document_id"),
    ]


@_query
def stream_trailing_engagement(v):
    """Sliding windows of a day every six hours over the pings' events, also those still open at the end."""
    return _trailing_stream(v)


@_query
def stream_trailing_error(v):
    """Exact counts of the stream's windows, and whether its estimates lie within three standard errors."""
    events = v.table("events").select(F.col("ts").cast("timestamp").alias("ts"), *_as_engagement())
    viewed, clicked = F.col("event_name") == "impression", F.col("event_name") == "click"
    exact = events.groupBy(F.window("ts", "1 day", "6 hours").alias("w"), "kind").agg(
        F.count_distinct(F.when(viewed, F.col("document_id"))).alias("impressions"),
        F.count_distinct(F.when(clicked, F.col("document_id"))).alias("opens"),
    )
    exact = exact.select(F.col("w.start").alias("window_start"), "kind", "impressions", "opens")
    both = exact.join(_trailing_stream(v), ["window_start", "kind"], "full")
    return both.select(
        "window_start", "window_end", "kind", "updated_at", "impressions", "opens",
        sketches.within_error(F.col("trailing_1_day_impressions"), F.col("impressions")).alias("impressions_close"),
        sketches.within_error(F.col("trailing_1_day_opens"), F.col("opens")).alias("opens_close"),
    )


#: Rows of a file that lands in a drop folder: enough that a micro-batch is worth what each one costs.
_ROWS_PER_LANDED_FILE = 2_000_000


@_query
def stream_latest(v):
    """Latest event per day and user from a drop folder with re-deliveries, read by two runs of one checkpoint."""
    events = v.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    drop, out, checkpoint = (shared_dir(v.spark, n) for n in ("latest-drop", "latest", "latest-checkpoint"))
    streams.keep_state_on_disk(v.spark)
    files = max(2, math.ceil(v.table("events").count() * 2 / 3 / _ROWS_PER_LANDED_FILE))
    for parts in ((0, 1), (1, 2)):
        events.filter(part.isin(*parts)).repartition(files).write.mode("append").parquet(drop)
        arriving = streams.file_stream(v.spark, drop, events.schema, files_per_trigger=2)
        latest = streams.latest_stream(arriving, "ts", ["user_id"], ["event_id"], late="60 days")
        streams.write_batches(latest, out, checkpoint, mode="update").awaitTermination()
    return streams.newest_rows(v.spark, out, ["period_start", "user_id"])


@_query
def stream_change_feed(v):
    """The change feed as payload requests per micro-batch (one batch here)."""
    schema = v.table("events").schema
    raw = streams.file_stream(v.spark, v.sf_dir, schema, glob="events.parquet")
    columns = v.plain("user_changes").columns
    expressions = view_columns(SPARK)["user_changes"][1]
    changes = raw.selectExpr(*[f"{expressions[c]} AS `{c}`" for c in columns])
    out, checkpoint = shared_dir(v.spark, "changes"), shared_dir(v.spark, "changes-checkpoint")
    query = streams.change_feed_stream(changes, out, checkpoint, "production")
    query.awaitTermination()
    rows = v.spark.read.parquet(out)
    return rows.select("step", "endpoint", "subscription_group_id", "chunk_no", "row_count")


@_query
def stream_articles(v):
    """Pages as gzip objects through the article stream: content rows of all micro-batches."""
    drop, out, failures, checkpoint = (shared_dir(v.spark, n) for n in ("drop", "content", "failures", "articles"))
    pages = v.table("pages").select(F.col("page_id").cast("string").alias("resolved_id"), F.col("html").alias("article"))
    pages.repartition(8, "resolved_id").write.option("compression", "gzip").json(drop)
    query = streams.article_stream(
        v.spark, drop, out, failures, checkpoint, "run-1", AS_OF, files_per_trigger=4, clean_source=False
    )
    query.awaitTermination()
    rows = v.spark.read.parquet(f"{out}/rows")
    return rows.select("resolved_id", F.md5("html").alias("html_md5"), F.col("text").isNotNull().alias("has_text"), "loaded_at")


@_query
def stream_article_outcomes(v):
    """Texts and dead letters that the article stream has written, where pages that are cut off fail to convert."""

    def convert(html: str) -> str:
        if "</body>" not in html:
            raise ValueError("cut off")
        return html_to_text(html)

    drop, out, failures, checkpoint = (shared_dir(v.spark, n) for n in ("drop", "content", "failures", "articles"))
    pages = v.table("pages").select(F.col("page_id").cast("string").alias("resolved_id"), F.col("html").alias("article"))
    pages.repartition(8, "resolved_id").write.option("compression", "gzip").json(drop)
    query = streams.article_stream(
        v.spark, drop, out, failures, checkpoint, "run-1", AS_OF, convert, files_per_trigger=4, clean_source=False
    )
    query.awaitTermination()
    rows = v.spark.read.parquet(f"{out}/rows").select("resolved_id", F.md5("html").alias("html_md5"), "text_md5")
    letters = v.spark.read.schema("resolved_id bigint, html string, error string").json(failures)
    letters = letters.select("resolved_id", F.md5("html").alias("_html_md5"), "error")
    both = rows.join(letters, "resolved_id", "full")
    return both.select(F.col("resolved_id").cast("bigint").alias("resolved_id"), F.coalesce("html_md5", "_html_md5").alias("html_md5"), "text_md5", "error")


@_query
def stream_archived_sources(v):
    """Where the pages of a drop folder are after two runs of one stream that archives what it has read.

    A quarter of the pages is a batch, of as many files as its rows need. The last one
    stays: it is moved when a later batch begins. Pages are read by all tasks, once, and
    only their digests are dealt to the files.
    """
    pages = materialized(v.table("pages").select("page_id", F.md5("html").alias("html_md5")), "page-digests")
    files = max(1, math.ceil(pages.count() / 4 / _ROWS_PER_LANDED_FILE))
    drop, archive, out, checkpoint = (shared_dir(v.spark, n) for n in ("sources", "archive", "archived", "archived-checkpoint"))
    # The files are moved by the stream itself, not by a thread beside it.
    v.spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    for parts in ((0, 1), (2, 3)):
        for part in parts:
            pages.filter(F.col("page_id") % 4 == part).repartition(files).write.mode("append").parquet(drop)
        arriving = streams.file_stream(v.spark, drop, pages.schema, files_per_trigger=files, archive=archive)
        streams.write_batches(arriving, out, checkpoint).awaitTermination()
    places = {"archive": archive, "drop": drop, "read": out}
    found = [
        v.spark.read.schema(pages.schema).option("recursiveFileLookup", "true").parquet(folder).withColumn("place", F.lit(place))
        for place, folder in places.items()
    ]
    return setops.concat_frames(*found)


@_query
def stream_offset_state(v):
    """Offsets that the change feed logs batch by batch, read twice from the start: the second time nothing is added."""
    schema = v.table("events").schema
    columns = v.plain("user_changes").columns
    expressions = view_columns(SPARK)["user_changes"][1]
    log = OffsetLog(v.spark, shared_dir(v.spark, "feed-offsets"))
    out = shared_dir(v.spark, "feed")
    for as_of in (AS_OF, LATER):
        raw = streams.file_stream(v.spark, v.sf_dir, schema, glob="events.parquet")
        changes = raw.selectExpr(*[f"{expressions[c]} AS `{c}`" for c in columns])
        checkpoint = shared_dir(v.spark, "feed-checkpoint")
        streams.change_feed_stream(changes, out, checkpoint, "production", log, "user_changes", as_of).awaitTermination()
    payloads = v.spark.read.parquet(out).agg(F.sum("row_count").alias("items"))
    return log.state().withColumn("items", payloads.scalar())
