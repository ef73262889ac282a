"""Roll-ups of legacy pings: one wide row per ping with an array of tiles.

Each job reduces a ping to what it needs before the de-duplication shuffles it:
the feed and the eligibility test become one value each, and the tiles of pings
that cannot qualify are blanked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, day_of, feed_name, flag_on, major_version, starts_with_digit_1_to_9
from ..operators.counting import distinct_flag_counts, sum_when
from ..operators.intervals import in_interval, month_lookback, rolling_days
from ..operators.latest import latest_per_key
from ..operators.unnest import explode_tiles, placed_tiles

TS = "submission_timestamp"


def choose_source(live: DataFrame, stable: DataFrame, for_backfill: bool) -> DataFrame:
    """Backfills read the stable table, regular runs the live one."""
    return stable if for_backfill else live


def _deduplicated(prepared: DataFrame, tie_break) -> DataFrame:
    """Latest row per (day, document); ``_keep`` marks rows that qualify."""
    with_day = prepared.withColumn("_day", F.to_date(TS))
    latest = latest_per_key(with_day, ["document_id", "_day"], TS, tie_break)
    return latest.filter("_keep")


def _with_feed(pings: DataFrame) -> DataFrame:
    return pings.withColumn("_feed", feed_name("normalized_country_code", "locale"))


def _old_version() -> Column:
    return major_version("version") <= fv.LAST_LEGACY_VERSION


def _released_in_feed() -> Column:
    return (F.col("release_channel") == fv.RELEASE_CHANNEL) & F.col("_feed").isNotNull()


def _valid_impression_ping() -> Column:
    return F.col("loaded").isNull() & _old_version() & (F.size("tiles") >= 1)


def _is_impression() -> Column:
    save = F.col(fv.LEGACY_SAVE_COLUMN)
    return F.col("click").isNull() & F.col("block").isNull() & save.isNull()


def _prepare(pings: DataFrame, keep: Column, tie_break, columns: dict[str, Column]) -> DataFrame:
    """Key columns, the test ``keep`` as ``_keep``, and the given columns of qualifying pings.

    The test has a projection of its own, so that it is evaluated once per row and
    not once per column.
    """
    tested = pings.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    return tested.select(
        TS,
        "document_id",
        *([tie_break] if isinstance(tie_break, str) else tie_break),
        "_keep",
        *[F.when(F.col("_keep"), column).alias(name) for name, column in columns.items()],
    )


def daily_disable_rate_legacy(sessions: DataFrame, start, end, tie_break=()) -> DataFrame:
    """Clients per day and feed that opened the tab or had sections switched off."""
    keep = _released_in_feed() & _old_version() & starts_with_digit_1_to_9("version")
    prepared = _prepare(
        _with_feed(sessions.filter(in_interval(TS, start, end))),
        keep,
        tie_break,
        {"feed_name": F.col("_feed"), "client_id": F.col("client_id"), "user_prefs": F.col("user_prefs")},
    )
    section, sponsored = flag_on("user_prefs", fv.FLAG_SECTION), flag_on("user_prefs", fv.FLAG_SPONSORED)
    counted = distinct_flag_counts(
        _deduplicated(prepared, tie_break).withColumnRenamed("_day", "happened_at"),
        ["happened_at", "feed_name"],
        "client_id",
        {
            "users_opening_new_tab_count": F.lit(True),
            fv.SECTION_DISABLED_COUNT: ~section,
            fv.SPONSORED_DISABLED_COUNT: ~sponsored,
            "users_eligible_for_spocs_count": section & sponsored,
        },
    )
    return counted.orderBy("happened_at", "feed_name")


def _per_second_counts(pings: DataFrame, tie_break, keep: Column, dimensions: dict[str, Column]) -> DataFrame:
    """Counts per (second, client, tile, position, dimensions) without click spam.

    A group with three or more clicks in one second is dropped as a whole.
    """
    prepared = _prepare(
        pings,
        keep,
        tie_break,
        {
            "tiles": F.col("tiles"),
            "client_id": F.col("impression_id"),
            "is_impression": _is_impression(),
            "is_click": F.col("click").isNotNull(),
            "is_save": F.col(fv.LEGACY_SAVE_COLUMN).isNotNull(),
            "is_block": F.col("block").isNotNull(),
            **dimensions,
        },
    )
    tiles = explode_tiles(_deduplicated(prepared, tie_break))
    per_second = tiles.groupBy(
        F.unix_seconds(TS).alias("second"), "client_id", "tile_id", "position", *dimensions
    ).agg(
        sum_when(F.col("is_impression")).alias("impressions"),
        sum_when(F.col("is_click")).alias("clicks"),
        sum_when(F.col("is_save")).alias("saves"),
        sum_when(F.col("is_block")).alias("dismissals"),
    )
    return per_second.filter(F.col("clicks") < fv.MAX_CLICKS_PER_SECOND)


def _unique_engagement(pings: DataFrame, spoc_tiles: DataFrame, period: Column, tie_break) -> DataFrame:
    counts = _per_second_counts(
        _with_feed(pings),
        tie_break,
        _valid_impression_ping() & _released_in_feed(),
        {"feed_name": F.col("_feed"), "user_prefs": F.col("user_prefs")},
    )
    both_on = flag_on("user_prefs", fv.FLAG_SECTION) & flag_on("user_prefs", fv.FLAG_SPONSORED)
    sponsored = F.col("type") == fv.SPONSORED_TYPE
    # What a client did with a tile in a period is folded before the tiles are joined.
    folded = (
        counts.groupBy(period.alias("happened_at"), "feed_name", "client_id", "tile_id", both_on.alias("both_on"))
        .agg(F.max(F.col("impressions") > 0).alias("viewed"), F.max(F.col("clicks") > 0).alias("clicked"))
    )
    # Whether a tile is sponsored is all the distinct counts need, so several entries
    # of one tile are folded and the join cannot multiply rows.
    tile_types = (
        spoc_tiles.filter(sponsored).select("tile_id").distinct().withColumn("is_spoc", F.lit(True))
    )
    joined = folded.join(tile_types, "tile_id", "left")
    viewed, clicked, both_on = F.col("viewed"), F.col("clicked"), F.col("both_on")
    is_spoc = F.col("is_spoc").isNotNull()
    return distinct_flag_counts(
        joined,
        ["happened_at", "feed_name"],
        "client_id",
        {
            "users_viewing_recs_count": viewed,
            "users_clicking_recs_count": clicked,
            "users_eligible_for_spocs_count": viewed & both_on,
            "users_viewing_spocs_count": viewed & both_on & is_spoc,
            "users_clicking_spocs_count": clicked & both_on & is_spoc,
        },
    )


def _second_to_day() -> Column:
    return F.to_date(F.timestamp_seconds("second"))


def daily_unique_engagement_legacy(
    pings: DataFrame, spoc_tiles: DataFrame, start, end, tie_break=()
) -> DataFrame:
    """Clients per day and feed that viewed or clicked recommendations or sponsored tiles."""
    scanned = pings.filter(in_interval(TS, start, end))
    result = _unique_engagement(scanned, spoc_tiles, _second_to_day(), tie_break)
    return result.orderBy("happened_at", "feed_name")


def monthly_unique_engagement_legacy(
    pings: DataFrame, spoc_tiles: DataFrame, start, end, tie_break=()
) -> DataFrame:
    """Month-to-date clients over a one-month look-back; one row per month in the window.

    ``aggregation_date``, the day of ``start``, is the key a load replaces by.
    """
    scanned = pings.filter(month_lookback(TS, start, end))
    month = F.trunc(_second_to_day(), "month")
    result = _unique_engagement(scanned, spoc_tiles, month, tie_break)
    return result.withColumn("aggregation_date", day_of(start)).orderBy("happened_at", "feed_name")


def fill_rate(counts: DataFrame, day_total_keys: list[str]) -> DataFrame:
    """Impressions by position next to the first-position total of its day (or day and feed).

    ``counts`` has few rows: one per (day, feed, position), so the totals come from a
    window over them rather than from a second pass. Groups without a first position
    have no total and are left out.
    """
    first = F.when(F.col("position") == 0, F.col("own_total"))
    total = F.sum(first).over(Window.partitionBy(*day_total_keys))
    return (
        counts.withColumn("new_tab_impression_count", total)
        .filter(F.col("position").isin(fv.SPONSORED_POSITIONS) & F.col("new_tab_impression_count").isNotNull())
        .select(
            "happened_at",
            "feed_name",
            "position",
            "new_tab_impression_count",
            "position_total_impression_count",
            F.coalesce("position_spoc_impression_count", F.lit(0)).alias("position_spoc_impression_count"),
        )
        .orderBy("happened_at", "feed_name", "position")
    )


def daily_spoc_fill_rate_legacy(pings: DataFrame, spoc_tiles: DataFrame, start, end, tie_break=()) -> DataFrame:
    """Sponsored share of impressions by position.

    The day total is that of all feeds together: it is matched on the day alone.
    """
    keep = (
        _valid_impression_ping()
        & _is_impression()
        & _released_in_feed()
        & flag_on("user_prefs", fv.FLAG_SECTION)
        & flag_on("user_prefs", fv.FLAG_SPONSORED)
    )
    prepared = _prepare(
        _with_feed(pings.filter(in_interval(TS, start, end))),
        keep,
        tie_break,
        {"tiles": placed_tiles("tiles", [0, *fv.SPONSORED_POSITIONS]), "feed_name": F.col("_feed")},
    )
    tiles = explode_tiles(_deduplicated(prepared, tie_break).withColumnRenamed("_day", "happened_at"))
    per_tile = (
        tiles.groupBy("happened_at", "feed_name", "tile_id", "position")
        .agg(F.count(F.lit(1)).alias("impressions"))
    )
    # A tile listed several times counts that often, as a plain left join would have
    # it; the weights keep the join at one row per tile.
    weights = spoc_tiles.groupBy("tile_id").agg(
        F.count(F.lit(1)).alias("entries"),
        sum_when(F.col("type") == fv.SPONSORED_TYPE).alias("spoc_entries"),
    )
    counts = (
        per_tile.join(weights, "tile_id", "left")
        .groupBy("happened_at", "feed_name", "position")
        .agg(
            F.sum("impressions").alias("own_total"),
            F.sum(F.col("impressions") * F.coalesce("entries", F.lit(1))).alias("position_total_impression_count"),
            F.sum(F.col("impressions") * F.col("spoc_entries")).alias("position_spoc_impression_count"),
        )
    )
    return fill_rate(counts, ["happened_at"])


def _engagement_by_tile(pings: DataFrame, as_of, tie_break, dimensions: dict[str, Column]) -> DataFrame:
    page = F.col("page")
    keep = _valid_impression_ping() & (page.isNull() | (page != fv.EXCLUDED_PAGE))
    counts = _per_second_counts(pings.filter(rolling_days(TS, as_of)), tie_break, keep, dimensions)
    keys = ["happened_at", "tile_id", "position", *dimensions]
    return (
        counts.withColumn("happened_at", _second_to_day())
        .groupBy(*keys)
        .agg(
            F.sum("impressions").alias("impression_count"),
            F.sum("clicks").alias("click_count"),
            F.sum("saves").alias("save_count"),
            F.sum("dismissals").alias("dismiss_count"),
        )
        .orderBy(*keys)
    )


def engagement_by_tile_position_legacy(pings: DataFrame, as_of, tie_break=()) -> DataFrame:
    """Daily impressions, clicks, saves and dismissals of yesterday and today."""
    return _engagement_by_tile(pings, as_of, tie_break, {})


def engagement_by_tile_position_locale_legacy(pings: DataFrame, as_of, tie_break=()) -> DataFrame:
    """As :func:`engagement_by_tile_position_legacy`, by source, locale and country too."""
    dimensions = {
        "source": F.col("source"),
        "locale": F.col("locale"),
        "country": F.col("normalized_country_code"),
    }
    return _engagement_by_tile(pings, as_of, tie_break, dimensions)


def trailing_engagement_activity_stream(pings: DataFrame, as_of) -> DataFrame:
    """Tiles of the last 24 hours with the most impressions.

    Every tile row counts as an impression, clicked ones included.
    """
    moment = as_timestamp(as_of)
    recent = pings.filter(
        (F.col(TS) > moment - F.expr("INTERVAL 24 HOURS"))
        & (F.col("addon_version") < fv.LEGACY_BUILD_BEFORE)
        & F.col("source").isin(fv.LEGACY_SOURCES)
        & F.col("loaded").isNull()
        & F.col("normalized_country_code").isNotNull()
        & (F.size("tiles") >= 1)
    )
    tiles = recent.select(TS, F.col("click").isNotNull().alias("is_click"), F.explode("tiles.id").alias("tile_id"))
    counts = tiles.groupBy(F.col("tile_id").cast("bigint").alias("tile_id")).agg(
        F.date_format(F.max(TS), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.count(F.lit(1)).alias("trailing_1_day_impressions"),
        sum_when(F.col("is_click")).alias("trailing_1_day_opens"),
    )
    return counts
