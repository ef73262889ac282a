"""Roll-ups of nested pings: an array of events, each with a key/value list.

The event array is cut to the wanted events and the read keys before the ping is
shuffled for de-duplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, feed_name, major_version, map_get, safe_boolean
from ..operators.counting import distinct_flag_counts, sum_when
from ..operators.intervals import in_interval, rolling_days
from ..operators.latest import latest_per_key
from ..operators.sketches import pane_sketches, united
from ..operators.tables import newer_than_target
from ..operators.unnest import explode_matching, explode_structs, slim_events
from .telemetry_legacy import TS, fill_rate

_LOCALE = "metrics.string.newtab_locale"
_SECTION = f"metrics.boolean.{fv.NESTED_SECTION_FLAG}"
_SPONSORED = f"metrics.boolean.{fv.NESTED_SPONSORED_FLAG}"


def _with_feed(pings: DataFrame) -> DataFrame:
    return pings.withColumn("_feed", feed_name("normalized_country_code", _LOCALE))


def _new_version() -> Column:
    return major_version("client_info.app_display_version") >= fv.FIRST_NESTED_VERSION


def _released_in_feed() -> Column:
    return (F.col("normalized_channel") == fv.RELEASE_CHANNEL) & F.col("_feed").isNotNull()


def _identified(events: Column) -> Column:
    """Events that name a recommendation or a tile."""
    return F.filter(events, lambda e: e["recommendation_id"].isNotNull() | e["tile_id"].isNotNull())


def _events(names: list[str], *fields: str) -> Column:
    extras = {f: (lambda pairs, f=f: map_get(pairs, f)) for f in ("recommendation_id", "tile_id", *fields)}
    return _identified(slim_events("events", fv.NESTED_CATEGORY, names, extras))


def _latest_pings(pings: DataFrame, keep: Column, tie_break, columns: dict[str, Column]) -> DataFrame:
    """Latest ping per (day, document) that passes ``keep``, reduced to the given columns."""
    tested = pings.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    prepared = tested.select(
        TS,
        "document_id",
        *([tie_break] if isinstance(tie_break, str) else tie_break),
        F.to_date(TS).alias("happened_at"),
        "_keep",
        *[F.when(F.col("_keep"), column).alias(name) for name, column in columns.items()],
    )
    return latest_per_key(prepared, ["document_id", "happened_at"], TS, tie_break).filter("_keep")


def daily_disable_rate_nested(pings: DataFrame, start, end, tie_break=()) -> DataFrame:
    """Clients per day and feed that opened the tab or had sections switched off.

    An unknown switch counts neither as off nor as eligible.
    """
    latest = _latest_pings(
        _with_feed(pings.filter(in_interval(TS, start, end))),
        _released_in_feed() & _new_version(),
        tie_break,
        {
            "feed_name": F.col("_feed"),
            "client_id": F.col("client_info.client_id"),
            "section": F.col(_SECTION),
            "sponsored": F.col(_SPONSORED),
        },
    )
    counted = distinct_flag_counts(
        latest,
        ["happened_at", "feed_name"],
        "client_id",
        {
            "users_opening_new_tab_count": F.lit(True),
            fv.SECTION_DISABLED_COUNT: ~F.col("section"),
            fv.SPONSORED_DISABLED_COUNT: ~F.col("sponsored"),
            "users_eligible_for_spocs_count": F.col("section") & F.col("sponsored"),
        },
    )
    return counted.orderBy("happened_at", "feed_name")


def daily_unique_engagement_nested(pings: DataFrame, start, end, tie_break=()) -> DataFrame:
    """Clients per day and feed that viewed or clicked; no click-spam filter applies here."""
    latest = _latest_pings(
        _with_feed(pings.filter(in_interval(TS, start, end))),
        _released_in_feed() & _new_version(),
        tie_break,
        {
            "feed_name": F.col("_feed"),
            "client_id": F.col("client_info.client_id"),
            "both_on": F.col(_SECTION) & F.col(_SPONSORED),
            "wanted": _events(["impression", "click"], "is_sponsored"),
        },
    )
    events = explode_structs(
        latest.select("happened_at", "feed_name", "client_id", "both_on", "wanted"), "wanted"
    )
    viewed, clicked = F.col("event_name") == "impression", F.col("event_name") == "click"
    sponsored = F.col("both_on") & safe_boolean("is_sponsored")
    counted = distinct_flag_counts(
        events,
        ["happened_at", "feed_name"],
        "client_id",
        {
            "users_viewing_recs_count": viewed,
            "users_clicking_recs_count": clicked,
            "users_eligible_for_spocs_count": viewed & F.col("both_on"),
            "users_viewing_spocs_count": viewed & sponsored,
            "users_clicking_spocs_count": clicked & sponsored,
        },
    )
    return counted.orderBy("happened_at", "feed_name")


def daily_spoc_fill_rate_nested(pings: DataFrame, start, end, tie_break=()) -> DataFrame:
    """Sponsored share of impressions by position, against the total of its day and feed."""
    latest = _latest_pings(
        _with_feed(pings.filter(in_interval(TS, start, end))),
        _released_in_feed() & _new_version() & F.col(_SECTION) & F.col(_SPONSORED),
        tie_break,
        {"feed_name": F.col("_feed"), "wanted": _events(["impression"], "position", "is_sponsored")},
    )
    events = explode_structs(latest.select("happened_at", "feed_name", "wanted"), "wanted")
    counts = (
        events.withColumn("position", F.col("position").try_cast("bigint"))
        .filter(F.col("position").isin([0, *fv.SPONSORED_POSITIONS]))
        .groupBy("happened_at", "feed_name", "position")
        .agg(
            F.count(F.lit(1)).alias("position_total_impression_count"),
            sum_when(safe_boolean("is_sponsored")).alias("position_spoc_impression_count"),
        )
        .withColumn("own_total", F.col("position_total_impression_count"))
    )
    return fill_rate(counts, ["happened_at", "feed_name"])


def _engagement(pings: DataFrame, as_of, tie_break, dimensions: dict[str, Column], constants: dict) -> DataFrame:
    latest = _latest_pings(
        pings.filter(rolling_days(TS, as_of)),
        _new_version(),
        tie_break,
        {"wanted": _events(fv.NESTED_EVENT_NAMES, "position"), **dimensions},
    )
    events = explode_structs(latest.select("happened_at", *dimensions, "wanted"), "wanted")
    name = F.col("event_name")
    counts = events.groupBy("happened_at", "recommendation_id", "tile_id", "position", *dimensions).agg(
        sum_when(name == "impression").alias("impression_count"),
        sum_when(name == "click").alias("click_count"),
        sum_when(name == "save").alias("save_count"),
        sum_when(name == "dismiss").alias("dismiss_count"),
    )
    return counts.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else counts


def engagement_by_tile_position_nested(pings: DataFrame, as_of, tie_break=()) -> DataFrame:
    """Daily counts of four events; ids stay text until a load casts them."""
    return _engagement(pings, as_of, tie_break, {}, {})


def engagement_by_tile_position_locale_nested(pings: DataFrame, as_of, tie_break=()) -> DataFrame:
    dimensions = {"locale": F.col(_LOCALE), "country": F.col("normalized_country_code")}
    return _engagement(pings, as_of, tie_break, dimensions, {"source": fv.NESTED_SOURCE})


def new_user_events(pings: DataFrame, collected: DataFrame, as_of) -> DataFrame:
    """Events newer than what ``collected`` holds, one row per recommendation entry."""
    moment = as_timestamp(as_of)
    fresh = newer_than_target(pings, collected, TS, moment - F.expr("INTERVAL 1 DAY"))
    events = explode_structs(
        fresh.filter(F.col("app_build") >= fv.NESTED_BUILD_FROM).select(
            TS,
            "document_id",
            F.filter(
                "events",
                lambda e: (e["category"] == fv.NESTED_CATEGORY) & e["name"].isin("click", "impression"),
            ).alias("wanted"),
        ),
        "wanted",
    )
    rows = explode_matching(
        events.select("document_id", TS, F.col("name").alias("event_name"), "extra"),
        "extra",
        "recommendation_id",
        "recommendation_id",
    )
    return rows.withColumn("_loaded_at", moment)


def engagement_panes(user_events: DataFrame, pane: str = "15 minutes") -> DataFrame:
    """Sketches of the viewing and the opening documents per pane and recommendation.

    Panes can be stored and united later; :func:`trailing_from_panes` needs no event again.
    """
    named = user_events.withColumnRenamed("recommendation_id", "corpus_recommendation_id")
    viewed, clicked = F.col("event_name") == "impression", F.col("event_name") == "click"
    counted = {
        "trailing_1_day_impressions": F.when(viewed, F.col("document_id")),
        "trailing_1_day_opens": F.when(clicked, F.col("document_id")),
    }
    return pane_sketches(named, TS, ["corpus_recommendation_id"], counted, pane)


def trailing_from_panes(panes: DataFrame, as_of) -> DataFrame:
    """Approximate counts per recommendation over the panes of the last day."""
    recent = panes.filter(F.col("pane") >= as_timestamp(as_of) - F.expr("INTERVAL 1 DAY"))
    counts = united(recent, ["corpus_recommendation_id"], ["trailing_1_day_impressions", "trailing_1_day_opens"])
    return counts.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def trailing_engagement_nested(user_events: DataFrame, as_of, exact: bool = False) -> DataFrame:
    """Recommendations of the last day with the most viewing documents.

    ``exact`` replaces the approximate by an exact distinct count.
    """
    recent = user_events.filter(F.col(TS) > as_timestamp(as_of) - F.expr("INTERVAL 1 DAY"))
    if not exact:
        return trailing_from_panes(engagement_panes(recent), as_of)
    viewed, clicked = F.col("event_name") == "impression", F.col("event_name") == "click"
    flagged = recent.withColumnRenamed("recommendation_id", "corpus_recommendation_id")
    # the latest time rides along as one more value per (recommendation, document)
    per_document = flagged.groupBy("corpus_recommendation_id", "document_id").agg(
        F.max(TS).alias("latest"),
        F.max(F.when(viewed, 1).otherwise(0)).alias("viewed"),
        F.max(F.when(clicked, 1).otherwise(0)).alias("clicked"),
    )
    known = F.col("document_id").isNotNull()
    return per_document.groupBy("corpus_recommendation_id").agg(
        F.date_format(F.max("latest"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.sum(F.when(known, F.col("viewed")).otherwise(0)).alias("trailing_1_day_impressions"),
        F.sum(F.when(known, F.col("clicked")).otherwise(0)).alias("trailing_1_day_opens"),
    )
