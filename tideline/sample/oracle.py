"""DuckDB SQL for the queries of :mod:`tideline.sample.catalog`.

Each text states its query directly over the sample views, without the rewrites the
Spark jobs use to move less data. Sums are cast to BIGINT, dates and times to text.
"""

from __future__ import annotations

from ..functions import fixed_values as fv
from .duck_views import with_views
from .rules import AS_OF, OWN_DOMAIN

_WHOLE = "submission_timestamp >= TIMESTAMP '2024-01-01' AND submission_timestamp < TIMESTAMP '2024-01-31'"
_MONTH = "submission_timestamp >= TIMESTAMP '2023-12-30' AND submission_timestamp < TIMESTAMP '2024-01-31'"
_ROLLING = "CAST(submission_timestamp AS DATE) BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'"
_TRAILING = "submission_timestamp > TIMESTAMP '2024-01-29 23:00:00'"
_OLD = "TRY_CAST(split_part(version, '.', 1) AS BIGINT) <= 120"
_NEW = "TRY_CAST(split_part(app_display_version, '.', 1) AS BIGINT) >= 121"
_SAVE = fv.LEGACY_SAVE_COLUMN
_POSITIONS = ", ".join(str(p) for p in fv.SPONSORED_POSITIONS)
_STAMP = "%Y-%m-%d %H:%M:%S.%f"
_ISO = "%Y-%m-%dT%H:%M:%SZ"


def _day(expression: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS VARCHAR)"


def _stamp(expression: str) -> str:
    return f"strftime({expression}, '{_STAMP}')"


def _big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def _distinct(condition: str, name: str, entity: str = "client_id") -> str:
    return f"count(DISTINCT CASE WHEN {condition} THEN {entity} END) AS {name}"


_BOTH_ON = "user_prefs & 4 = 4 AND user_prefs & 32 = 32"


def _legacy_engagement(period: str, where: str, more: str = "") -> str:
    return with_views("legacy_tiles", "spoc_tiles", where=where) + f""",
    counts AS (
        SELECT CAST(floor(epoch(submission_timestamp)) AS BIGINT) AS sec, min(day) AS day, feed_name, impression_id AS client_id,
               user_prefs, tile_id, position,
               sum(CASE WHEN click IS NULL AND block IS NULL AND {_SAVE} IS NULL THEN 1 ELSE 0 END) AS impressions,
               sum(CASE WHEN click IS NOT NULL THEN 1 ELSE 0 END) AS clicks
        FROM legacy_tiles
        WHERE loaded IS NULL AND {_OLD} AND release_channel = 'release' AND feed_name IS NOT NULL
        GROUP BY sec, feed_name, impression_id, user_prefs, tile_id, position)
    SELECT {period} AS happened_at, feed_name,
           {_distinct("impressions > 0", "users_viewing_recs_count")},
           {_distinct("clicks > 0", "users_clicking_recs_count")},
           {_distinct(f"impressions > 0 AND {_BOTH_ON}", "users_eligible_for_spocs_count")},
           {_distinct(f"impressions > 0 AND {_BOTH_ON} AND type = 'spoc'", "users_viewing_spocs_count")},
           {_distinct(f"clicks > 0 AND {_BOTH_ON} AND type = 'spoc'", "users_clicking_spocs_count")}{more}
    FROM counts LEFT JOIN spoc_tiles USING (tile_id)
    WHERE clicks < 3 GROUP BY ALL"""


def _legacy_by_tile(dimensions: list[tuple[str, str]]) -> str:
    named = "".join(f", {expression} AS {name}" for name, expression in dimensions)
    names = "".join(f", {name}" for name, _ in dimensions)
    return with_views("legacy_tiles", where=_ROLLING) + f""",
    counts AS (
        SELECT CAST(floor(epoch(submission_timestamp)) AS BIGINT) AS sec, min(day) AS day, impression_id, tile_id, position{named},
               sum(CASE WHEN click IS NULL AND block IS NULL AND {_SAVE} IS NULL THEN 1 ELSE 0 END) AS impressions,
               sum(CASE WHEN click IS NOT NULL THEN 1 ELSE 0 END) AS clicks,
               sum(CASE WHEN {_SAVE} IS NOT NULL THEN 1 ELSE 0 END) AS saves,
               sum(CASE WHEN block IS NOT NULL THEN 1 ELSE 0 END) AS dismissals
        FROM legacy_tiles
        WHERE loaded IS NULL AND {_OLD} AND (page IS NULL OR page <> '{fv.EXCLUDED_PAGE}')
        GROUP BY sec, impression_id, tile_id, position{names})
    SELECT {_day("day")} AS happened_at, tile_id, position{names},
           {_big("sum(impressions)", "impression_count")}, {_big("sum(clicks)", "click_count")},
           {_big("sum(saves)", "save_count")}, {_big("sum(dismissals)", "dismiss_count")}
    FROM counts WHERE clicks < 3 GROUP BY ALL"""


_NESTED_EVENT = f"category = '{fv.NESTED_CATEGORY}' AND (recommendation_id IS NOT NULL OR tile_id IS NOT NULL)"


def _nested_by_tile(dimensions: list[tuple[str, str]], more: str = "") -> str:
    named = "".join(f", {expression} AS {name}" for name, expression in dimensions)
    counts = ", ".join(
        _big(f"sum(CASE WHEN name = '{name}' THEN 1 ELSE 0 END)", f"{name}_count") for name in fv.NESTED_EVENT_NAMES
    )
    return with_views("nested_events", where=_ROLLING) + f"""
    SELECT {_day("day")} AS happened_at, recommendation_id, tile_id, position{named}, {counts}{more}
    FROM nested_events WHERE {_NESTED_EVENT} AND {_NEW} GROUP BY ALL"""


_USER_EVENTS = f"""
    SELECT document_id, submission_timestamp, name AS event_name, recommendation_id
    FROM (SELECT p.*, CASE WHEN t.j = 0 THEN first_name ELSE 'impression' END AS name,
                 CASE WHEN event_id % 11 <> 0 AND (event_id + t.j) % 3 <> 2
                      THEN CAST(event_id - event_id % 4 AS VARCHAR) END AS recommendation_id
          FROM nested_pings p CROSS JOIN (VALUES (0), (1)) t(j))
    WHERE {_TRAILING} AND app_build >= '{fv.NESTED_BUILD_FROM}' AND category = '{fv.NESTED_CATEGORY}'
      AND name IN ('click', 'impression') AND recommendation_id IS NOT NULL"""

_TRAILING_NESTED = f"""
    SELECT recommendation_id AS corpus_recommendation_id, strftime(max(submission_timestamp), '{_ISO}') AS updated_at,
           count(DISTINCT CASE WHEN event_name = 'impression' THEN document_id END) AS trailing_1_day_impressions,
           count(DISTINCT CASE WHEN event_name = 'click' THEN document_id END) AS trailing_1_day_opens
    FROM user_events GROUP BY 1"""

_TRAILING_LEGACY = f"""
    SELECT tile_id, strftime(max(submission_timestamp), '{_ISO}') AS updated_at,
           count(*) AS trailing_1_day_impressions,
           {_big("sum(CASE WHEN click IS NOT NULL THEN 1 ELSE 0 END)", "trailing_1_day_opens")}
    FROM (SELECT p.*, CASE WHEN week_user THEN t.i ELSE (event_id * 7 + t.i * 13) % 997 END AS tile_id
          FROM legacy_pings p CROSS JOIN (VALUES (0), (1), (2)) t(i) WHERE tile_count = 3)
    WHERE {_TRAILING} AND addon_version < '{fv.LEGACY_BUILD_BEFORE}' AND source IN ('TOP_STORIES', 'CARDGRID')
      AND loaded IS NULL AND normalized_country_code IS NOT NULL
    GROUP BY 1"""


def _telemetry() -> dict[str, str]:
    fill_tail = """
    SELECT {day} AS happened_at, a.feed_name, a.position, min(n.total)::BIGINT AS new_tab_impression_count,
           sum(a.impressions)::BIGINT AS position_total_impression_count,
           coalesce(sum(CASE WHEN {spoc} THEN a.impressions END), 0)::BIGINT AS position_spoc_impression_count
    """
    per_day = "CAST(a.day AS VARCHAR)"
    return {
        "daily_disable_rate_legacy": with_views("legacy_dedup", where=_WHOLE) + f"""
            SELECT {_day("day")} AS happened_at, feed_name, count(DISTINCT client_id) AS users_opening_new_tab_count,
                   {_distinct("user_prefs & 4 <> 4", fv.SECTION_DISABLED_COUNT)},
                   {_distinct("user_prefs & 32 <> 32", fv.SPONSORED_DISABLED_COUNT)},
                   {_distinct(_BOTH_ON, "users_eligible_for_spocs_count")}
            FROM legacy_dedup
            WHERE release_channel = 'release' AND {_OLD} AND regexp_matches(version, '^[1-9]') AND feed_name IS NOT NULL
            GROUP BY 1, 2""",
        "daily_unique_engagement_legacy": _legacy_engagement(_day("day"), _WHOLE),
        "monthly_unique_engagement_legacy": _legacy_engagement(
            _day("date_trunc('month', day)"), _MONTH, ", '2024-01-30' AS aggregation_date"
        ),
        "daily_spoc_fill_rate_legacy": with_views("legacy_tiles", "spoc_tiles", where=_WHOLE) + f""",
            counts AS (
                SELECT CAST(floor(epoch(submission_timestamp)) AS BIGINT) AS sec, min(day) AS day, feed_name, tile_id, position, count(*) AS impressions
                FROM legacy_tiles
                WHERE loaded IS NULL AND {_OLD} AND click IS NULL AND block IS NULL AND {_SAVE} IS NULL
                  AND release_channel = 'release' AND {_BOTH_ON} AND feed_name IS NOT NULL
                GROUP BY sec, feed_name, tile_id, position),
            totals AS (SELECT day, sum(impressions) AS total FROM counts WHERE position = 0 GROUP BY 1)
            {fill_tail.format(day=per_day, spoc="t.type = 'spoc'")}
            FROM counts a LEFT JOIN spoc_tiles t USING (tile_id) JOIN totals n ON n.day = a.day
            WHERE a.position IN ({_POSITIONS}) GROUP BY 1, 2, 3""",
        "engagement_by_tile_position_legacy": _legacy_by_tile([]),
        "engagement_by_tile_position_locale_legacy": _legacy_by_tile(
            [("source", "source"), ("locale", "locale"), ("country", "normalized_country_code")]
        ),
        "trailing_engagement_activity_stream": with_views("legacy_pings") + _TRAILING_LEGACY,
        "daily_disable_rate_nested": with_views("nested_dedup", where=_WHOLE) + f"""
            SELECT {_day("day")} AS happened_at, feed_name, count(DISTINCT client_id) AS users_opening_new_tab_count,
                   {_distinct("section_on = FALSE", fv.SECTION_DISABLED_COUNT)},
                   {_distinct("sponsored_on = FALSE", fv.SPONSORED_DISABLED_COUNT)},
                   {_distinct("section_on AND sponsored_on", "users_eligible_for_spocs_count")}
            FROM nested_dedup WHERE normalized_channel = 'release' AND {_NEW} AND feed_name IS NOT NULL
            GROUP BY 1, 2""",
        "daily_unique_engagement_nested": with_views("nested_events", where=_WHOLE) + f"""
            SELECT {_day("day")} AS happened_at, feed_name,
                   {_distinct("name = 'impression'", "users_viewing_recs_count")},
                   {_distinct("name = 'click'", "users_clicking_recs_count")},
                   {_distinct("name = 'impression' AND section_on AND sponsored_on", "users_eligible_for_spocs_count")},
                   {_distinct("name = 'impression' AND section_on AND sponsored_on AND is_sponsored",
                              "users_viewing_spocs_count")},
                   {_distinct("name = 'click' AND section_on AND sponsored_on AND is_sponsored",
                              "users_clicking_spocs_count")}
            FROM nested_events
            WHERE {_NESTED_EVENT} AND name IN ('impression', 'click') AND normalized_channel = 'release' AND {_NEW}
              AND feed_name IS NOT NULL GROUP BY 1, 2""",
        "daily_spoc_fill_rate_nested": with_views("nested_events", where=_WHOLE) + f""",
            counts AS (
                SELECT day, feed_name, TRY_CAST(position AS BIGINT) AS position, is_sponsored, count(*) AS impressions
                FROM nested_events
                WHERE {_NESTED_EVENT} AND name = 'impression' AND normalized_channel = 'release' AND {_NEW}
                  AND section_on AND sponsored_on AND feed_name IS NOT NULL
                GROUP BY ALL),
            totals AS (SELECT day, feed_name, sum(impressions) AS total FROM counts WHERE position = 0 GROUP BY 1, 2)
            {fill_tail.format(day=per_day, spoc="a.is_sponsored")}
            FROM counts a JOIN totals n ON n.day = a.day AND n.feed_name = a.feed_name
            WHERE a.position IN ({_POSITIONS}) GROUP BY 1, 2, 3""",
        "engagement_by_tile_position_nested": _nested_by_tile([]),
        "engagement_by_tile_position_locale_nested": _nested_by_tile(
            [("locale", "newtab_locale"), ("country", "normalized_country_code")], ", 'CARDGRID' AS source"
        ),
        "new_user_events": with_views("nested_pings") + f"""
            SELECT document_id, {_stamp("submission_timestamp")} AS submission_timestamp, event_name, recommendation_id
            FROM ({_USER_EVENTS})""",
        "trailing_engagement_nested_exact": with_views("nested_pings")
        + f", user_events AS ({_USER_EVENTS}) {_TRAILING_NESTED}",
        "trailing_engagement_nested_error": with_views("nested_pings")
        + f""", user_events AS ({_USER_EVENTS})
            SELECT *, TRUE AS trailing_1_day_impressions_close, TRUE AS trailing_1_day_opens_close FROM ({_TRAILING_NESTED})""",
        "aggregate_engagement": with_views("nested_pings", "legacy_pings", "recommendations") + f""",
            user_events AS ({_USER_EVENTS}), nested AS ({_TRAILING_NESTED}), legacy AS ({_TRAILING_LEGACY}),
            item_keys AS (
                SELECT *, recommendation_surface_id || '/' || corpus_slate_configuration_id || '/' || corpus_item_id AS key
                FROM recommendations WHERE recommended_at > TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 28 DAYS),
            joined AS (
                SELECT updated_at, key, recommendation_surface_id, corpus_slate_configuration_id, corpus_item_id,
                       trailing_1_day_impressions, trailing_1_day_opens
                FROM nested JOIN (SELECT DISTINCT corpus_recommendation_id, key, recommendation_surface_id,
                                         corpus_slate_configuration_id, corpus_item_id FROM item_keys)
                USING (corpus_recommendation_id)
                UNION ALL
                SELECT updated_at, key, recommendation_surface_id, corpus_slate_configuration_id, corpus_item_id,
                       trailing_1_day_impressions, trailing_1_day_opens
                FROM legacy JOIN (SELECT DISTINCT tile_id, key, recommendation_surface_id,
                                         corpus_slate_configuration_id, corpus_item_id FROM item_keys)
                USING (tile_id))
            SELECT updated_at, key, recommendation_surface_id, corpus_slate_configuration_id, corpus_item_id,
                   {_big("sum(trailing_1_day_impressions)", "trailing_1_day_impressions")},
                   {_big("sum(trailing_1_day_opens)", "trailing_1_day_opens")},
                   {", ".join(f"0::BIGINT AS {name}" for name in fv.TRAILING_COUNTERS[2:])}
            FROM joined WHERE key IS NOT NULL AND recommendation_surface_id IS NOT NULL
              AND corpus_slate_configuration_id IS NOT NULL AND corpus_item_id IS NOT NULL
            GROUP BY 1, 2, 3, 4, 5""",
    }


def _backend_events() -> str:
    c = fv.BACKEND_CONTEXTS

    def first(context: str, key: str) -> str:
        return f"json_extract_string({c[context]}, '$[0].{key}')"

    paths = " OR ".join(f"page_urlpath LIKE '{p}'" for p in fv.PAGE_PATHS)

    def drop_nulls(text: str) -> str:
        # a merge patch removes the keys whose value is null, at every level
        return f"CAST(json_merge_patch('{{}}'::JSON, {text}) AS VARCHAR)"

    os_version = f"{first('agent', 'osMajor')} || {first('agent', 'osMinor')}"
    return with_views("backend_raw") + f""",
    selected AS (
        SELECT * FROM backend_raw
        WHERE collector_tstamp >= TIMESTAMP '2024-01-01' AND collector_tstamp < TIMESTAMP '2024-01-31'
          AND ((event_name = 'list_item_update' AND json_extract_string({c["item_update"]}, '$.trigger') = 'save')
               OR event_name = 'content_open' OR event_name = 'app_open'
               OR event_name = 'page_view' AND ({first("user", "hashed_user_id")} IS NOT NULL OR {paths})
                  AND app_id NOT LIKE '{fv.DEV_APP_PATTERN}' AND app_id LIKE '{fv.APP_PATTERN}')
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY collector_tstamp) = 1)
    SELECT {_stamp("collector_tstamp")} AS submission_timestamp, {_stamp("derived_tstamp")} AS event_timestamp, app_id,
           {drop_nulls(f'''json_object('metadata', json_object(
               'geo', json_object('city', geo_city, 'country', geo_country),
               'user_agent', json_object('browser', {first("agent", "useragentFamily")},
                   'os', {first("agent", "osFamily")},
                   'version', {first("agent", "useragentMajor")} || {first("agent", "useragentMinor")})))''')} AS metadata,
           {drop_nulls(f'''json_object('client_info', json_object(
               'app_build', coalesce({first("app", "version")}, {first("api_user", "client_version")}),
               'client_id', {first("user", "hashed_guid")}, 'user_id', {first("user", "hashed_user_id")},
               'locale', br_lang, 'os', {first("agent", "osFamily")}, 'os_version', {os_version}))''')} AS client_info,
           'event' AS event_category, event_name,
           {drop_nulls(f'''json_object('api_id', coalesce(CAST({first("api_user", "api_id")} AS INT), 0),
               'page_url_host', page_urlhost, 'page_url_path', page_urlpath, 'page_url_query', page_urlquery,
               'bottom_ui_type', {first("ui", "type")}, 'bottom_ui_component_detail', {first("ui", "component_detail")},
               'bottom_ui_identifier', {first("ui", "identifier")},
               'bottom_ui_index', CAST({first("ui", "index")} AS INT))''')} AS event_extras
    FROM selected"""


def _feed(name: str) -> str:
    columns, unix_columns, local_columns = fv.CURATED_FEEDS[name]
    listed = []
    for column in columns:
        if column in unix_columns:
            value = f"strftime(epoch_ms({column} * 1000), '%Y-%m-%d %H:%M:%S')"
        elif column in local_columns:
            # New York is five hours behind UTC in winter, four in summer
            value = f"strftime(({column} AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"
        else:
            value = f"nullif(CAST({column} AS VARCHAR), '')"
        listed.append(f"{value} AS {column}")
    return with_views(name) + f" SELECT {', '.join(listed)}, '{AS_OF}.000000' AS loaded_at FROM {name}"


def _features() -> dict[str, str]:
    approved = ", ".join(
        f"sum(CASE WHEN a.topic = '{topic}' THEN 1 ELSE 0 END) AS num_approved_{name}"
        for topic, name in fv.APPROVED_TOPICS
    )
    approved_names = [f"num_approved_{name}" for _, name in fv.APPROVED_TOPICS] + ["num_approved"]
    return {
        "backend_events_export": _backend_events(),
        "curated_feed_items_refresh": _feed("curated_feed_items"),
        "curated_feed_deleted_refresh": _feed("curated_feed_items_deleted"),
        "curated_feed_prospects_refresh": _feed("curated_feed_prospects"),
        "curated_feed_queued_refresh": _feed("curated_feed_queued_items"),
        "tile_source_refresh": _feed("tile_source"),
        "publisher_features": with_views("content", "engagement_by_day", "approved_items", "scheduled_content") + f""",
            saves AS (
                SELECT c.top_domain_name, count(DISTINCT c.resolved_url) AS num_items,
                       avg(d.save_count * date_diff('day', c.first_parsed_at, d.happened_at)) AS avg_save_age,
                       sum(d.save_count) AS save_count
                FROM engagement_by_day d JOIN content c ON c.content_id = d.content_id
                LEFT JOIN scheduled_content s ON s.content_id = c.content_id
                WHERE d.happened_at BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31'
                  AND c.first_parsed_at BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-31'
                  AND c.language = 'en' AND c.word_count >= 900 AND d.save_count > 0
                  AND c.domain_id <> {OWN_DOMAIN} AND s.content_id IS NULL
                GROUP BY 1),
            topics AS (
                SELECT c.top_domain_name AS approved_source, {approved},
                       sum(CASE WHEN a.topic <> '{fv.EXCLUDED_TOPIC}' THEN 1 ELSE 0 END) AS num_approved
                FROM content c JOIN approved_items a ON a.content_id = c.content_id
                WHERE a.topic IS NOT NULL AND a.reviewed_corpus_item_created_at > TIMESTAMP '{AS_OF}' - INTERVAL 360 DAYS
                GROUP BY 1)
            SELECT top_domain_name, {", ".join(f"coalesce({n}, 0)::BIGINT AS {n}" for n in approved_names)},
                   {_big("save_count", "total_save_count")}, round(avg_save_age, 6) AS avg_save_age,
                   round(CAST(save_count AS DOUBLE) / num_items, 6) AS avg_save_count, num_items AS num_items_saved,
                   round(ln(save_count), 6) AS log_total_saves, '2024-01-31T00:00:00Z' AS updated_at
            FROM saves LEFT JOIN topics ON top_domain_name = approved_source WHERE top_domain_name IS NOT NULL""",
        "user_impressions": with_views("impressions", "recommendations") + """,
            prep AS (
                SELECT r.hashed_user_id, r.corpus_item_id, count(*) AS impression_count, min(i.happened_at) AS first_time
                FROM impressions i JOIN recommendations r USING (corpus_recommendation_id)
                WHERE i.happened_at > TIMESTAMP '2024-01-31' - INTERVAL 29 DAYS AND r.hashed_user_id IS NOT NULL
                GROUP BY 1, 2),
            listed AS (SELECT * FROM prep WHERE impression_count > 9 UNION
                       SELECT * FROM prep WHERE first_time < TIMESTAMP '2024-01-31' - INTERVAL 14 DAYS)
            SELECT hashed_user_id, '2024-01-31T00:00:00Z' AS updated_at,
                   '[' || string_agg(DISTINCT corpus_item_id, ',' ORDER BY corpus_item_id) || ']' AS corpus_ids
            FROM listed GROUP BY 1""",
        "corpus_item_engagement": with_views("trailing_by_item") + f"""
            SELECT surface_configuration_item_key AS key, strftime(updated_at_day, '{_ISO}') AS updated_at,
                   recommendation_surface_id, corpus_slate_configuration_id, corpus_item_id,
                   {", ".join(fv.TRAILING_COUNTERS)}
            FROM trailing_by_item""",
    }


def _revenue() -> dict[str, str]:
    rows = """
        SELECT CAST(o_orderdate AS DATE) AS record_date, l_returnflag AS network,
               'https://' || l_linestatus || '.example' AS url,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ad_unit,
               CASE WHEN l_linenumber % 2 = 0 THEN '300x250' END AS size,
               CAST(l_quantity AS BIGINT) AS impressions, l_orderkey AS net_revenue,
               CAST(printf('%.2f', l_discount) AS DOUBLE) AS net_cpm
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    nothing = ["utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term", "site_domain", "country_code", "device_type", "device_os", "browser", "integration_partner"]
    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in nothing)
    return {
        "revenue_load": f"""
            WITH dealt AS (SELECT *, net_revenue % 28 AS n FROM ({rows}))
            SELECT CAST(DATE '1998-02-20' + CAST(n AS INTEGER) AS VARCHAR) AS record_date, network, ad_unit,
                   CASE WHEN n % 3 = 0 OR n >= 14 THEN url END AS url, CASE WHEN n % 3 = 0 OR n >= 14 THEN size END AS size,
                   CASE WHEN n % 3 = 0 THEN -impressions ELSE impressions END AS impressions, net_revenue, net_cpm, {nulls}
            FROM dealt""",
        "revenue_days_without_rows": """
            SELECT CAST(d AS VARCHAR) AS day FROM (
                SELECT CAST(d AS DATE) AS d FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '1998-08-03', INTERVAL 1 DAY) t(d))
            WHERE day(d) % 5 = 0 OR d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""",
        "revenue_page_rows": f"""
            SELECT CAST(record_date AS VARCHAR) AS record_date, network, url, ad_unit, size, impressions, net_revenue,
                   net_cpm, {nulls} FROM ({rows})""",
        "revenue_key_replace": f"""
            WITH rows AS ({rows}), batch AS (SELECT * FROM rows WHERE record_date >= DATE '1998-06-01')
            SELECT CAST(record_date AS VARCHAR) AS record_date, network, ad_unit, impressions FROM batch
            UNION ALL
            SELECT CAST(record_date AS VARCHAR), network, ad_unit, -impressions FROM rows
            WHERE month(record_date) <> 7 AND record_date NOT IN (SELECT record_date FROM batch)""",
        "revenue_days_to_load": """
            SELECT CAST(day AS VARCHAR) AS day FROM (
                SELECT CAST(d AS DATE) AS day FROM range(TIMESTAMP '1998-03-06', TIMESTAMP '1998-03-20', INTERVAL 1 DAY) t(d))
            WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) % 3 <> 0)""",
        "missing_days": """
            SELECT CAST(day AS VARCHAR) AS day FROM (
                SELECT CAST(d AS DATE) AS day FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-02', INTERVAL 1 DAY) t(d))
            WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) % 2 = 1)""",
    }


def _scores() -> dict[str, str]:
    joined = """
        SELECT publisher_id, content_id, save_cnt, open_cnt, favorite_cnt, share_cnt
        FROM score_groups q LEFT JOIN lifetime l USING (publisher_id, content_id)
        WHERE save_cnt IS NOT NULL AND open_cnt IS NOT NULL AND favorite_cnt IS NOT NULL AND share_cnt IS NOT NULL
          AND (save_cnt > 0 OR open_cnt > 0 OR favorite_cnt > 0 OR share_cnt > 0)"""

    def down(total: str, part: str, up: str, prior: str) -> str:
        misses = f"CAST({total} - {part} AS DOUBLE) + {prior}::DOUBLE"
        return f"CASE WHEN {total} >= {part} THEN {misses} ELSE ({misses} + {up}) * 4 END"

    open_uv = "open_cnt + 2.2::DOUBLE + save_cnt * 0.05::DOUBLE"
    fav_uv = "favorite_cnt + 0.2::DOUBLE + open_cnt * 0.02::DOUBLE"
    share_uv = "share_cnt + 0.2::DOUBLE + open_cnt * 0.02::DOUBLE"
    values = {
        "open_uv": open_uv,
        "open_dv": down("save_cnt", "open_cnt", open_uv, "7.8"),
        "fav_uv": fav_uv,
        "fav_dv": down("open_cnt", "favorite_cnt", fav_uv, "9.8"),
        "share_uv": share_uv,
        "share_dv": down("open_cnt", "share_cnt", share_uv, "9.8"),
    }
    return {
        "content_score_inputs": with_views("lifetime") + f"""
            SELECT publisher_id, content_id, save_cnt, open_cnt, favorite_cnt, share_cnt,
                   {", ".join(f"round({value}, 6) AS {name}" for name, value in values.items())}
            FROM ({joined})""",
        "content_score": _content_score(joined, values),
        "content_score_queue_left": with_views("lifetime") + f""",
            scored AS ({joined})
            SELECT publisher_id, content_id, CASE WHEN content_id <= {fv.SCORE_MAX_SMALL_ID} THEN 'small' ELSE 'large' END AS target
            FROM scored
            UNION ALL
            SELECT publisher_id, content_id, 'queue' FROM score_groups q
            WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.publisher_id = q.publisher_id AND s.content_id = q.content_id)""",
    }


def _content_score(joined: str, values: dict[str, str]) -> str:
    """Quantiles by halving an interval; the incomplete beta function by its continued fraction from the far end."""
    p = 1 / (1 + fv.SCORE_LOSS_MULTIPLE)
    rates = {"open_score": "open", "favorite_score": "fav", "share_score": "share"}
    pairs = " UNION ".join(f"SELECT {name}_uv AS a, {name}_dv AS b FROM inputs" for name in rates.values())

    def term(k: str, a: str, b: str, x: str) -> str:
        even = f"({k} / 2) * ({b} - {k} / 2) * {x} / (({a} + {k} - 1) * ({a} + {k}))"
        odd = f"-({a} + ({k} - 1) / 2) * ({a} + {b} + ({k} - 1) / 2) * {x} / (({a} + {k} - 1) * ({a} + {k}))"
        return f"CASE WHEN {k} % 2 = 0 THEN {even} ELSE {odd} END"

    def tail(a: str, b: str, x: str) -> str:
        deep = f"list_reduce(places, lambda acc, k: 1 + ({term('k', a, b, x)}) / acc, 1::DOUBLE)"
        return f"exp({a} * ln({x}) + {b} * ln(1 - {x}) + lgamma({a} + {b}) - lgamma({a}) - lgamma({b})) / ({a} * {deep})"

    total = fv.SCORE_WEIGHTS
    weighted = " + ".join(f"{name}_score * {weight}::DOUBLE" for name, weight in total.items())
    selected = ", ".join(f"(SELECT x FROM solved WHERE a = {rate}_uv AND b = {rate}_dv) AS {name}" for name, rate in rates.items())
    return with_views("lifetime") + f""",
        inputs AS (SELECT publisher_id, content_id, save_cnt, {", ".join(f"{v} AS {n}" for n, v in values.items())} FROM ({joined})),
        pairs AS ({pairs}),
        far AS (SELECT list_reverse(list_transform(range(1, 301), lambda i: i::DOUBLE)) AS places),
        halved AS (
            WITH RECURSIVE steps AS (
                SELECT a, b, 0::DOUBLE AS low, 1::DOUBLE AS high, 0 AS n FROM pairs
                UNION ALL
                SELECT a, b, CASE WHEN below < {p!r}::DOUBLE THEN x ELSE low END, CASE WHEN below < {p!r}::DOUBLE THEN high ELSE x END, n + 1
                FROM (
                    SELECT *, CASE WHEN x < (a + 1) / (a + b + 2) THEN {tail("a", "b", "x")}
                                   ELSE 1 - {tail("b", "a", "(1 - x)")} END AS below
                    FROM (SELECT *, (low + high) / 2 AS x FROM steps, far WHERE n < 48)))
            SELECT * FROM steps),
        solved AS (SELECT a, b, (low + high) / 2 AS x FROM halved WHERE n = 48),
        scored AS (SELECT *, {selected} FROM inputs)
        SELECT publisher_id, content_id, save_cnt, open_uv, open_dv, fav_uv, fav_dv, share_uv, share_dv,
               {", ".join(f"round({name}, 4) AS {name}" for name in rates)},
               round(({weighted}) / {sum(total.values())!r}::DOUBLE, 4) AS total_score
        FROM scored"""


_RECENCY = "strftime(recency, '%Y-%m-%d %H:%M:%S') AS recency"
_NOW = f"TIMESTAMP '{AS_OF}'"
_SETS = {set_id: (kind, params) for set_id, _, kind, params in fv.STATIC_CANDIDATE_SETS}


def _per_set(kind: str, make) -> str:
    """One SELECT per fixed set of the kind, united."""
    return "\nUNION ALL\n".join(
        f"SELECT '{set_id}' AS candidate_set_id, id, topic, publisher, recency FROM ({make(params)})"
        for set_id, (k, params) in _SETS.items()
        if k == kind
    )


_REVIEWED = f"""
    SELECT approved_corpus_item_external_id AS id, topic, publisher, reviewed_corpus_item_updated_at AS recency,
           scheduled_surface_id
    FROM approved_items WHERE corpus_review_status = 'recommendation' AND NOT is_syndicated AND NOT is_collection"""
_MANUAL = f"""
    SELECT approved_corpus_item_external_id AS id, topic, publisher, scheduled_corpus_item_scheduled_at AS recency,
           scheduled_surface_id
    FROM scheduled_items WHERE corpus_item_loaded_from = 'MANUAL' AND NOT is_syndicated AND NOT is_collection"""
_LATEST = "QUALIFY row_number() OVER (PARTITION BY id ORDER BY recency DESC NULLS FIRST, topic DESC, publisher DESC) = 1"


def _candidate_texts() -> dict[str, str]:
    """SELECT over approved_items, scheduled_items and topics, per kind, with recency as a time."""

    def collections(p: dict) -> str:
        return f"""
            SELECT * FROM (SELECT a.approved_corpus_item_external_id AS id, a.topic, a.publisher,
                   coalesce(s.scheduled_corpus_item_scheduled_at, a.reviewed_corpus_item_created_at) AS recency
            FROM approved_items a LEFT JOIN scheduled_items s
              ON s.approved_corpus_item_external_id = a.approved_corpus_item_external_id
              AND s.scheduled_corpus_item_scheduled_at < {_NOW} AND s.scheduled_surface_id = '{p["scheduled_surface_id"]}'
            WHERE a.is_collection AND a.corpus_review_status = 'recommendation' AND a.language = '{p["language"]}'
              AND recency BETWEEN {_NOW} - INTERVAL {-p["max_age_days"]} DAYS AND {_NOW}
              AND a.approved_corpus_item_external_id <> '{fv.EXCLUDED_ITEM_ID}')
            {_LATEST}"""

    def hacks(p: dict) -> str:
        topics = ", ".join(f"'{t}'" for t in fv.LIFE_HACK_TOPICS)
        return f"""
            SELECT * FROM (SELECT * FROM ({_MANUAL}) WHERE recency < {_NOW} UNION ALL {_REVIEWED})
            WHERE scheduled_surface_id = '{p["scheduled_surface_id"]}' AND topic IN ({topics})
              AND id <> '{fv.EXCLUDED_ITEM_ID}' AND recency >= {_NOW} - INTERVAL {p["max_age_days"]} DAYS {_LATEST}"""

    def hits(p: dict) -> str:
        return f"""
            SELECT * FROM (
                SELECT approved_corpus_item_external_id AS id, topic, publisher, scheduled_corpus_item_scheduled_at AS recency
                FROM scheduled_items
                WHERE scheduled_surface_id = '{p["scheduled_surface_id"]}'
                  AND approved_corpus_item_external_id <> '{fv.EXCLUDED_ITEM_ID}'
                  AND date_trunc('day', scheduled_corpus_item_scheduled_at) + INTERVAL 7 HOURS < {_NOW} {_LATEST})
            ORDER BY recency DESC, id LIMIT 8"""

    def scheduled(p: dict) -> str:
        return f"""
            SELECT approved_corpus_item_external_id AS id, topic, publisher, scheduled_corpus_item_scheduled_at AS recency
            FROM scheduled_items
            WHERE scheduled_surface_id = '{p["scheduled_surface_id"]}' AND NOT is_syndicated AND NOT is_collection
              AND approved_corpus_item_external_id <> '{fv.EXCLUDED_ITEM_ID}'
              AND scheduled_corpus_item_scheduled_at BETWEEN {_NOW} - INTERVAL {-p["max_age_days"]} DAYS AND {_NOW} {_LATEST}"""

    def recommended(p: dict) -> str:
        return f"""
            SELECT * FROM (
                SELECT * FROM (SELECT * FROM ({_MANUAL}) WHERE recency < {_NOW} UNION ALL
                               SELECT * FROM ({_REVIEWED}) WHERE id <> '{fv.EXCLUDED_ITEM_ID}')
                WHERE scheduled_surface_id = '{p["scheduled_surface_id"]}' {_LATEST})
            QUALIFY row_number() OVER (PARTITION BY topic ORDER BY recency DESC NULLS FIRST, id) <= {p["n_per_topic"]}"""

    topic = f"""
        SELECT candidate_set_id, id, topic, publisher, recency FROM (
            SELECT * FROM ({_REVIEWED}) WHERE recency >= {_NOW} - INTERVAL 90 DAYS
            UNION
            SELECT * FROM ({_MANUAL}) WHERE recency BETWEEN {_NOW} - INTERVAL 90 DAYS AND {_NOW})
        JOIN (SELECT curated_catalog_candidate_set_id AS candidate_set_id, corpus_topic_id AS topic,
                     '{fv.SURFACE_EN_US}' AS scheduled_surface_id FROM topics
              UNION ALL
              SELECT german_curated_catalog_candidate_set_id, corpus_topic_id, '{fv.SURFACE_DE_DE}' FROM topics)
        USING (topic, scheduled_surface_id)
        WHERE id <> '{fv.EXCLUDED_ITEM_ID}'
        QUALIFY row_number() OVER (PARTITION BY candidate_set_id, id ORDER BY recency DESC, publisher DESC) = 1"""
    return {
        "collections_by_recency": _per_set("collections_by_recency", collections),
        "life_hacks": _per_set("life_hacks", hacks),
        "daily_hits": _per_set("daily_hits", hits),
        "scheduled_items": _per_set("scheduled_items", scheduled),
        "recommended_by_recency": _per_set("recommended_by_recency", recommended),
        "topic_items": topic,
    }


def _configs() -> str:
    fixed = ", ".join(
        f"('{i}', '{name}', '{kind}', '', '{p['scheduled_surface_id']}')" for i, name, kind, p in fv.STATIC_CANDIDATE_SETS
    )
    topic_sets = "\nUNION ALL\n".join(
        f"SELECT {column}, '{prefix}' || lower(corpus_topic_id), 'topic_items', corpus_topic_id, '{surface}' FROM topics"
        for column, prefix, surface in (
            ("curated_catalog_candidate_set_id", "en_us/", fv.SURFACE_EN_US),
            ("german_curated_catalog_candidate_set_id", "de_de/", fv.SURFACE_DE_DE),
        )
    )
    return f"""
        SELECT *, CASE WHEN name LIKE '%coronavirus%' THEN 0::BIGINT ELSE 1::BIGINT END AS min_item_count FROM (
            SELECT * FROM (VALUES {fixed}) t(candidate_set_id, name, kind, topic, scheduled_surface_id)
            UNION ALL {topic_sets})"""


def _legacy_set(params: dict, body: str, limit: int, after: str = "TRUE") -> str:
    return f"""
        SELECT '{params["candidate_set_id"]}' AS candidate_set_id, {params.get("feed_id", 1)}::BIGINT AS feed_id, id, publisher,
               {_RECENCY} FROM (SELECT * FROM ({body}) ORDER BY recency DESC, id, publisher LIMIT {limit}) WHERE {after}"""


def _reads(sets: list[dict], words: str) -> str:
    def body(p: dict) -> str:
        return f"""
            SELECT a.resolved_id AS id, c.top_domain_name AS publisher, a.reviewed_corpus_item_updated_at AS recency
            FROM approved_items a JOIN content c ON c.content_id = a.content_id
            WHERE a.reviewed_corpus_item_updated_at >= {_NOW} - INTERVAL 90 DAYS AND c.word_count {words}
              AND a.corpus_review_status = 'recommendation' AND a.scheduled_surface_id = '{p["scheduled_surface_id"]}'
              AND a.language = '{p["language"]}' AND NOT a.is_syndicated"""

    return "\nUNION ALL\n".join(f"({_legacy_set(p, body(p), 90)})" for p in sets)


def _candidates() -> dict[str, str]:
    texts = _candidate_texts()
    items = with_views("approved_items", "scheduled_items", "topics")
    result = {
        name: f"{items} SELECT candidate_set_id, id, topic, publisher, {_RECENCY} FROM ({text})"
        for name, text in texts.items()
    }
    everything = "\nUNION ALL\n".join(f"SELECT candidate_set_id, id, topic, publisher, recency FROM ({t})" for t in texts.values())
    result["candidate_configs"] = f"{items} {_configs()}"
    item_json = """'{"ID":' || to_json(id) || ',"TOPIC":' || to_json(topic) || ',"PUBLISHER":' || to_json(publisher) || '}'"""
    result["candidate_set_json"] = f"""{items}, items AS ({everything}),
        messages AS (SELECT candidate_set_id, count(*) AS n,
                            '[' || string_agg({item_json}, ',' ORDER BY recency DESC NULLS FIRST, id) || ']' AS j
                     FROM items GROUP BY 1)
        SELECT c.candidate_set_id AS id, name, coalesce(n, 0)::BIGINT AS item_count,
               '2024-01-31T00:00:00Z' AS unloaded_at, coalesce(j, '[]') AS corpus_items
        FROM ({_configs()}) c LEFT JOIN messages m USING (candidate_set_id)"""

    def scheduled(p: dict, days: int) -> str:
        return f"""s.scheduled_corpus_item_scheduled_at BETWEEN {_NOW} - INTERVAL {days} DAYS AND {_NOW}
                   AND s.scheduled_surface_id = '{p["scheduled_surface_id"]}'"""

    def curated(p: dict) -> str:
        after = "is_collection" if p["collections_only"] else "NOT is_syndicated" if p["not_syndicated"] else "TRUE"
        body = f"""
            SELECT s.resolved_id AS id, c.top_domain_name AS publisher, s.scheduled_corpus_item_scheduled_at AS recency,
                   s.is_collection, s.is_syndicated
            FROM scheduled_items s JOIN content c ON c.content_id = s.content_id WHERE {scheduled(p, 7)}"""
        return f"({_legacy_set(p, body, 300, after)})"

    def syndicated(p: dict) -> str:
        body = f"""
            SELECT s.resolved_id AS id, c.domain AS publisher, s.scheduled_corpus_item_scheduled_at AS recency
            FROM scheduled_items s JOIN syndicated_articles c ON c.{fv.SYNDICATED_KEY} = s.resolved_id WHERE {scheduled(p, 9)}"""
        return f"({_legacy_set(p, body, 180)})"

    with_content = with_views("approved_items", "scheduled_items", "content", "topics")
    shortreads = _reads(fv.LEGACY_SHORTREADS, "<= 900")
    candidate_json = """'{"item_id":' || id || ',"publisher":' || to_json(publisher) || ',"feed_id":' || feed_id || '}'"""
    result |= {
        "legacy_longreads": f"{with_content} {_reads(fv.LEGACY_LONGREADS, '>= 4500')}",
        "legacy_shortreads": f"{with_content} {shortreads}",
        "legacy_curated_feeds": f"{with_content} " + "\nUNION ALL\n".join(curated(p) for p in fv.LEGACY_CURATED_FEEDS),
        "legacy_syndicated": with_views("scheduled_items", "syndicated_articles")
        + "\n" + "\nUNION ALL\n".join(syndicated(p) for p in fv.LEGACY_SYNDICATED),
        "legacy_topics": f"""{with_content}
            SELECT candidate_set_id, 1::BIGINT AS feed_id, id, publisher, {_RECENCY} FROM (
                SELECT t.legacy_curated_catalog_candidate_set_id AS candidate_set_id, a.resolved_id AS id,
                       c.top_domain_name AS publisher, a.reviewed_corpus_item_updated_at AS recency
                FROM approved_items a JOIN content c ON c.content_id = a.content_id JOIN topics t ON t.corpus_topic_id = a.topic
                WHERE a.reviewed_corpus_item_updated_at >= {_NOW} - INTERVAL 90 DAYS AND a.language = 'EN'
                  AND a.corpus_review_status = 'recommendation')
            QUALIFY row_number() OVER (PARTITION BY candidate_set_id ORDER BY recency DESC, id, publisher) <= 45""",
        "legacy_candidate_messages": f"""{with_content}, items AS (SELECT * REPLACE (coalesce(publisher, 'unknown') AS publisher) FROM ({shortreads}))
            SELECT candidate_set_id, count(*) AS row_count,
                   '{{"id":"' || candidate_set_id || '","version":3,"candidates":['
                   || string_agg({candidate_json}, ',' ORDER BY recency DESC, id, publisher)
                   || '],"type":"recommendation","flow":"shortreads","run":"run-1","expires_at":'
                   || {1706659200 + fv.MESSAGE_EXPIRY_SECONDS} || '}}' AS message
            FROM items GROUP BY 1""",
        "legacy_item_violations": f"""{with_content}, items AS ({shortreads}),
            sets AS (SELECT DISTINCT candidate_set_id FROM items UNION ALL SELECT 'no-such-set')
            SELECT candidate_set_id, count(i.candidate_set_id) AS item_count,
                   CAST(count(*) FILTER (i.candidate_set_id IS NOT NULL AND (id IS NULL OR coalesce(publisher, '') = '')) AS BIGINT) AS bad_items
            FROM sets LEFT JOIN items i USING (candidate_set_id) GROUP BY 1 HAVING item_count < 1 OR bad_items > 0""",
    }
    return result


def _user_sync() -> dict[str, str]:
    flag, locale, event = fv.NEW_ALIAS_FLAG_COLUMN, fv.USER_LOCALE_COLUMN, fv.EVENT_NAME_COLUMN
    group = "subscribe_to_newsletter_subscription_group_name"
    newsletter, frequency = "newsletter_signup_event_newsletter", "newsletter_signup_event_frequency"
    deltas = with_views("user_changes") + f""",
        deltas AS (
            SELECT * FROM (
                SELECT event_id, loaded_at, happened_at, user_event_trigger, nullif(external_id, '') AS external_id,
                       nullif(email, '') AS email, CASE WHEN email = '' AND {flag} THEN FALSE ELSE {flag} END AS has_email,
                       is_premium, time_zone, country, {locale}, {group}, email_subscribe, {event}, {newsletter}, {frequency}
                FROM user_changes WHERE loaded_at > TIMESTAMP '2024-01-10')
            WHERE NOT (email IS NULL AND external_id IS NULL)),
        valid AS (SELECT * FROM deltas)"""

    def compact(text: str) -> str:
        return f"CAST(json_merge_patch('{{}}'::JSON, {text}) AS VARCHAR)"

    groups = " ".join(f"WHEN '{name}' THEN '{i}'" for name, i in fv.SUBSCRIPTION_GROUPS["production"].items())
    alias_only = """CASE WHEN external_id IS NULL THEN json_object('alias_label', 'email', 'alias_name', email) END"""
    attributes = compact(f"""json_object('external_id', external_id, 'user_alias', {alias_only}, '_update_existing_only', TRUE,
        'email', email, 'email_subscribe', email_subscribe, 'country', country, 'time_zone', time_zone,
        'is_premium', is_premium, '{locale}', {locale})""")
    signup = f"json_object('newsletter', {newsletter}, 'frequency', {frequency})"
    event_text = compact(f"""json_object('external_id', external_id, 'user_alias', {alias_only}, 'name', {event},
        'time', strftime(happened_at, '{_ISO}'),
        'properties', CASE WHEN {event} = '{fv.SIGNUP_EVENT}' THEN {signup} ELSE json_object() END)""")
    alias = compact("json_object('alias_label', 'email', 'alias_name', email, 'external_id', external_id)")
    identify = compact(
        "json_object('external_id', external_id, 'user_alias', json_object('alias_label', 'email', 'alias_name', email))"
    )
    id_text = "CAST(to_json(external_id) AS VARCHAR)"
    address = f"CASE WHEN external_id IS NULL AND regexp_matches(email, '{fv.EMAIL_PATTERN}') THEN CAST(to_json(email) AS VARCHAR) END"
    item = f"""
        SELECT 1::BIGINT AS step, '/users/alias/new' AS endpoint, '' AS subscription_group_id, event_id, loaded_at,
               {alias} AS main, CAST(NULL AS VARCHAR) AS extra FROM valid WHERE has_email
        UNION ALL
        SELECT 2, '/users/identify', '', event_id, loaded_at, {identify}, NULL FROM valid WHERE has_email
        UNION ALL
        SELECT 3, '/subscription/status/set', CASE {group} {groups} END, event_id, loaded_at,
               CASE WHEN external_id IS NOT NULL THEN {id_text} END, {address} FROM valid WHERE {group} <> ''
        UNION ALL
        SELECT 4, '/users/track?=', '', event_id, loaded_at, {attributes}, CASE WHEN {event} <> '' THEN {event_text} END FROM valid
        UNION ALL
        SELECT 5, '/users/delete', '', event_id, loaded_at, CASE WHEN external_id IS NOT NULL THEN {id_text} END, NULL
        FROM valid WHERE user_event_trigger = '{fv.DELETE_TRIGGER}'"""
    items = f"{deltas}, items AS ({item})"
    names = ["alias", "identify"]
    result = {
        "user_deltas": f"""{deltas}
            SELECT * EXCLUDE (happened_at, loaded_at), {_stamp('loaded_at')} AS loaded_at, {_stamp('happened_at')} AS happened_at
            FROM deltas""",
        "user_deltas_masked": with_views("user_changes") + f"""
            SELECT event_id, external_id, email, has_email FROM (
                SELECT event_id, loaded_at, nullif(external_id, '') AS external_id,
                       CASE WHEN email <> '' THEN split_part(email, '@', 1) || '@example.com' END AS email,
                       CASE WHEN email = '' AND {flag} THEN FALSE ELSE {flag} END AS has_email
                FROM user_changes WHERE loaded_at > TIMESTAMP '2024-01-10')
            WHERE NOT (email IS NULL AND external_id IS NULL)""",
        "user_delta_offset": f"{deltas} SELECT {_stamp('max(loaded_at)')} AS last_offset FROM deltas",
        "subscribe_rows": f"{items} SELECT event_id, subscription_group_id, main, extra FROM items WHERE step = 3",
        "track_rows": f"{items} SELECT event_id, main AS attributes, extra AS event FROM items WHERE step = 4",
        "delete_rows": f"{items} SELECT event_id, main FROM items WHERE step = 5",
        "user_delta_payloads": f"""{items},
            chunked AS (SELECT *, (row_number() OVER (PARTITION BY step, subscription_group_id ORDER BY loaded_at, event_id) - 1)
                                  // CASE WHEN step = 4 THEN 75 ELSE 50 END AS chunk_no FROM items),
            bodies AS (
                SELECT step, endpoint, subscription_group_id, chunk_no, count(*) AS row_count,
                       coalesce(string_agg(main, ',' ORDER BY loaded_at, event_id), '') AS main,
                       coalesce(string_agg(extra, ',' ORDER BY loaded_at, event_id), '') AS extra
                FROM chunked GROUP BY 1, 2, 3, 4)
            SELECT step, endpoint, subscription_group_id, CAST(chunk_no AS BIGINT) AS chunk_no, row_count, md5(CASE step
                WHEN 1 THEN '{{"user_aliases":[' || main || ']}}'
                WHEN 2 THEN '{{"aliases_to_identify":[' || main || ']}}'
                WHEN 3 THEN '{{"subscription_group_id":"' || subscription_group_id || '","subscription_state":"subscribed"'
                            || CASE WHEN main <> '' THEN ',"external_id":[' || main || ']' ELSE '' END
                            || CASE WHEN extra <> '' THEN ',"email":[' || extra || ']' ELSE '' END || '}}'
                WHEN 4 THEN '{{"attributes":[' || main || '],"events":[' || extra || ']}}'
                ELSE '{{"external_ids":[' || main || ']}}' END) AS payload_md5
            FROM bodies""",
    }
    for step, name in enumerate(names, start=1):
        result[f"{name}_rows"] = f"{items} SELECT event_id, endpoint, main FROM items WHERE step = {step}"
    result["stream_change_feed"] = with_views("user_changes") + f""",
        valid AS (
            SELECT * FROM (
                SELECT event_id, loaded_at, happened_at, user_event_trigger, nullif(external_id, '') AS external_id,
                       nullif(email, '') AS email, CASE WHEN email = '' AND {flag} THEN FALSE ELSE {flag} END AS has_email,
                       is_premium, time_zone, country, {locale}, {group}, email_subscribe, {event}, {newsletter}, {frequency}
                FROM user_changes)
            WHERE NOT (email IS NULL AND external_id IS NULL)), items AS ({item})
        SELECT step, endpoint, subscription_group_id, CAST(chunk_no AS BIGINT) AS chunk_no, count(*) AS row_count FROM (
            SELECT *, (row_number() OVER (PARTITION BY step, subscription_group_id ORDER BY loaded_at, event_id) - 1)
                      // CASE WHEN step = 4 THEN 75 ELSE 50 END AS chunk_no FROM items)
        GROUP BY 1, 2, 3, 4"""
    result["stream_offset_state"] = (
        result["stream_change_feed"].replace("SELECT step, endpoint, subscription_group_id, CAST(chunk_no AS BIGINT)", ", feed AS (SELECT step, endpoint, subscription_group_id, CAST(chunk_no AS BIGINT)", 1)
        + f""")
        SELECT 'user_changes' AS sql_folder_name, '{AS_OF}.000000' AS created_at, '{AS_OF}.000000' AS updated_at,
               (SELECT rtrim(rtrim(strftime(max(loaded_at), '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') FROM user_changes) AS last_offset,
               CAST((SELECT sum(row_count) FROM feed) AS BIGINT) AS items"""
    )
    return result


def _retention() -> dict[str, str]:
    users = "user_id IN (SELECT user_id FROM deleted_users WHERE user_id IS NOT NULL)"
    hashed = "hashed_user_id IN (SELECT hashed_user_id FROM deleted_users WHERE hashed_user_id IS NOT NULL)"

    def kept(view: str, condition: str, columns: str = "*") -> str:
        return f"SELECT {columns} FROM {view} WHERE NOT coalesce({condition}, FALSE)"

    new_users = """
        SELECT DISTINCT a.hashed_user_id, a.user_id FROM deleted_users a
        LEFT JOIN known b ON b.hashed_user_id = a.hashed_user_id AND b.user_id = a.user_id WHERE b.hashed_user_id IS NULL"""

    def new_emails(listed: str) -> str:
        return f"""
            SELECT DISTINCT m.email FROM email_map m JOIN {listed} u ON u.user_id = m.user_id
            LEFT JOIN known_emails e ON e.email = m.email WHERE e.email IS NULL"""

    payload_user = "CAST(json_extract_string(event, '$.data.user_id') AS BIGINT)"
    payload_key = "json_extract_string(event, '$.data.user_key')"
    key_type = "json_extract_string(event, '$.data.user_key_type_id') = '1'"
    columns = "event_id, user_id, user_key_type_id"
    all_users = f"SELECT hashed_user_id, user_id FROM known UNION ALL ({new_users})"
    by_user, by_email = "user_id IN (SELECT user_id FROM ids)", "email IN (SELECT email FROM addresses)"
    return {
        "new_deleted_users": with_views("deleted_users", "known") + new_users,
        "new_deleted_emails": with_views("deleted_users", "known_emails") + new_emails("deleted_users"),
        "purge_plain_key": with_views("user_orders", "deleted_users") + kept("user_orders", users),
        "purge_json_key": with_views("event_payloads", "deleted_users")
        + kept("event_payloads", f"{payload_user} IN (SELECT user_id FROM deleted_users)", columns),
        "purge_two_keys": with_views("user_orders", "deleted_users")
        + kept("user_orders", f"coalesce({users}, FALSE) OR coalesce({hashed}, FALSE)"),
        "purge_extra_predicate": with_views("event_payloads", "deleted_users")
        + kept("event_payloads", f"{payload_key} IN (SELECT CAST(user_id AS VARCHAR) FROM deleted_users) AND {key_type}", columns),
        "purge_flag": with_views("user_orders") + kept("user_orders", "is_deleted"),
        "purge_deleted_accounts": with_views("user_orders", "event_payloads", "context_events", "deleted_users", "known", "known_emails") + f""",
            users AS ({all_users}), emails AS (SELECT email FROM known_emails UNION ALL ({new_emails("users")})),
            ids AS (SELECT user_id FROM users WHERE user_id IS NOT NULL),
            addresses AS (SELECT email FROM emails WHERE email IS NOT NULL)
            SELECT 'deleted_users' AS table_name, hashed_user_id AS row_key FROM users
            UNION ALL SELECT 'deleted_emails', email FROM emails
            UNION ALL SELECT 'orders_by_user', CAST(o_orderkey AS VARCHAR) FROM user_orders WHERE NOT coalesce({by_user}, FALSE)
            UNION ALL SELECT 'orders_by_hash_or_user', CAST(o_orderkey AS VARCHAR) FROM user_orders
                      WHERE NOT coalesce({by_user}, FALSE)
                        AND NOT coalesce(hashed_user_id IN (SELECT hashed_user_id FROM users WHERE hashed_user_id IS NOT NULL), FALSE)
            UNION ALL SELECT 'orders_by_email', CAST(o_orderkey AS VARCHAR) FROM user_orders WHERE NOT coalesce({by_email}, FALSE)
            UNION ALL SELECT 'orders_by_user_or_email', CAST(o_orderkey AS VARCHAR) FROM user_orders
                      WHERE NOT coalesce({by_user}, FALSE) AND NOT coalesce({by_email}, FALSE)
            UNION ALL SELECT 'payloads_by_user', CAST(event_id AS VARCHAR) FROM event_payloads
                      WHERE NOT coalesce({payload_user} IN (SELECT user_id FROM ids), FALSE)
            UNION ALL SELECT 'payloads_of_one_type', CAST(event_id AS VARCHAR) FROM event_payloads
                      WHERE NOT coalesce({payload_key} IN (SELECT CAST(user_id AS VARCHAR) FROM ids) AND {key_type}, FALSE)
            UNION ALL SELECT 'events_by_context', CAST(event_id AS VARCHAR) FROM context_events
                      WHERE NOT coalesce(json_extract_string(context, '$[0].user_id') IN (SELECT CAST(user_id AS VARCHAR) FROM ids), FALSE)
                        AND NOT coalesce(json_extract_string(context, '$[0].hashed_user_id')
                                         IN (SELECT hashed_user_id FROM users WHERE hashed_user_id IS NOT NULL), FALSE)
            UNION ALL SELECT 'orders_flagged', CAST(o_orderkey AS VARCHAR) FROM user_orders
                      WHERE NOT coalesce(is_deleted, FALSE)""",
    }


def _maintenance() -> dict[str, str]:
    orders = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"
    articles = """
        SELECT page_id AS resolved_id, length(html) AS size, md5(html) AS text_md5, TIMESTAMP '2024-01-01' AS loaded_at FROM pages
        UNION ALL
        SELECT page_id, length(html) + 1, md5(html), TIMESTAMP '2024-01-02' FROM pages WHERE page_id % 5 = 0"""
    latest = f"""
        SELECT * FROM ({articles}) QUALIFY row_number() OVER (PARTITION BY resolved_id ORDER BY loaded_at DESC) = 1"""
    name = "concat_ws('/', c_mktsegment, c_nationkey)"
    return {
        "interval_plan": f"""
            WITH b AS (SELECT min(ts) + INTERVAL 1 MICROSECOND AS a, max(ts) AS z FROM events),
            points AS (SELECT a AS p FROM b UNION ALL
                       SELECT d FROM b, range(date_trunc('day', a) + INTERVAL 1 DAY, date_trunc('day', z) + INTERVAL 1 DAY,
                                              INTERVAL 1 DAY) t(d)
                       UNION ALL SELECT z FROM b WHERE z > date_trunc('day', z)),
            pairs AS (SELECT p, lead(p) OVER (ORDER BY p) AS q, row_number() OVER (ORDER BY p) AS n, count(*) OVER () AS c FROM points)
            SELECT {_stamp("p")} AS batch_start, {_stamp("q")} AS batch_end,
                   {_stamp("CASE WHEN a = date_trunc('day', a) THEN a ELSE date_trunc('day', a) + INTERVAL 1 DAY END")}
                       AS first_interval_start,
                   {_stamp("z")} AS sets_end, n = 1 AS is_initial, n = c - 1 AS is_final
            FROM pairs, b WHERE q IS NOT NULL""",
        "tag_batches": f"""
            WITH e AS (
                SELECT event_id, greatest(date_trunc('day', ts), TIMESTAMP '2024-01-05 13:30:00.000001') AS s,
                       least(date_trunc('day', ts) + INTERVAL 1 DAY, TIMESTAMP '2024-01-20 08:00:00') AS e
                FROM events WHERE ts >= TIMESTAMP '2024-01-05 13:30:00.000001' AND ts < TIMESTAMP '2024-01-20 08:00:00')
            SELECT event_id, {_stamp("s")} AS batch_start, {_stamp("e")} AS batch_end FROM e""",
        "stale_partitions": """
            WITH t AS (SELECT date_trunc('millisecond', ts) AS ts FROM events)
            SELECT DISTINCT CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN 'date=' || strftime(ts, '%Y-%m-%d')
                                 ELSE 'date=' || strftime(ts, '%Y-%m-%d') || '/time=' || strftime(ts, '%H-%M-%S-%g') END AS folder
            FROM t WHERE ts >= TIMESTAMP '2024-01-10 15:00:00' AND ts < TIMESTAMP '2024-01-20 06:00:00'""",
        "range_replace": f"""
            WITH rows AS ({orders}), batch AS (SELECT * FROM rows WHERE day >= DATE '2000-03-01' AND o_orderkey % 2 = 0),
            target AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN day END AS day FROM rows)
            SELECT o_orderkey, CAST(day AS VARCHAR) AS day, 'new' AS state FROM batch
            UNION ALL SELECT o_orderkey, CAST(day AS VARCHAR), 'old' FROM target
            WHERE NOT coalesce(day >= (SELECT min(day) FROM batch), FALSE)""",
        "key_replace": f"""
            WITH rows AS ({orders}), batch AS (SELECT * FROM rows WHERE day(day) <= 10 AND o_orderkey % 2 = 0)
            SELECT o_orderkey, CAST(day AS VARCHAR) AS day, 'new' AS state FROM batch
            UNION ALL SELECT o_orderkey, CAST(day AS VARCHAR), 'old' FROM rows WHERE day NOT IN (SELECT day FROM batch)""",
        "append_newer": f"""
            SELECT event_id, {_stamp("ts")} AS ts, event_type FROM events
            WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-12 12:00:00')""",
        "upsert_offsets": f"""
            WITH state AS (SELECT {name} AS k, min(c_custkey) AS o FROM customer WHERE c_nationkey < 15 GROUP BY 1),
            batch AS (SELECT {name} AS k, max(c_custkey) AS o FROM customer WHERE c_nationkey >= 10 GROUP BY 1)
            SELECT coalesce(s.k, b.k) AS sql_folder_name,
                   CASE WHEN s.k IS NOT NULL THEN '2024-01-01' ELSE '2024-01-31' END || ' 00:00:00.000000' AS created_at,
                   CASE WHEN b.k IS NOT NULL THEN '2024-01-31' ELSE '2024-01-01' END || ' 00:00:00.000000' AS updated_at,
                   CAST(CASE WHEN b.k IS NOT NULL THEN b.o ELSE s.o END AS VARCHAR) AS last_offset
            FROM state s FULL OUTER JOIN batch b ON s.k = b.k""",
        "compact_latest": f"""
            SELECT resolved_id, size, text_md5, {_stamp("loaded_at")} AS loaded_at, '{AS_OF}.000000' AS last_ordered FROM ({latest})""",
        "versioned_table_swap": f"""
            SELECT resolved_id, size, text_md5, {_stamp("loaded_at")} AS loaded_at FROM ({latest})""",
        **{
            name: f"""
            SELECT day, event_type, n, state, CASE WHEN state = 'start' THEN 'date=2024-01-31' ELSE 'date=' || day END AS _gs_file_date
            FROM (
                SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n,
                       CASE WHEN CAST(ts AS DATE) < DATE '2024-01-26' THEN 'start'
                            WHEN CAST(ts AS DATE) >= DATE '{again}' THEN 'again' ELSE 'first' END AS state
                FROM events WHERE ts < date_trunc('day', TIMESTAMP '{AS_OF}') GROUP BY 1, 2, 4)"""
            for name, again in (("incremental_run", "2025-01-01"), ("incremental_backfill", "2024-01-28"))
        },
        "offset_state": f"""
            SELECT 'counts_one' AS sql_folder_name, '{AS_OF}.000000' AS created_at, '{AS_OF}.000000' AS updated_at,
                   strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_offset
            FROM events WHERE ts < date_trunc('day', TIMESTAMP '{AS_OF}')
            UNION ALL
            SELECT 'counts_two', '{AS_OF}.000000', '2024-02-01 00:00:00.000000', strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f')
            FROM events WHERE ts < TIMESTAMP '2024-01-30'""",
        "replace_days": """
            SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
                   CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN 'new' ELSE 'old' END AS state
            FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-24'""",
        "staged_export_load": f"""
            SELECT o_orderkey, o_totalprice, o_orderstatus,
                   CASE WHEN o_orderkey % 2 = 0 THEN 'date=2024-01-05' ELSE 'date=2024-01-06' END AS file_date,
                   CASE WHEN o_orderkey % 2 = 0 THEN 'time=00-00-00-000' ELSE 'time=12-30-00-000' END AS file_time,
                   TRUE AS has_row_number, '{AS_OF}.000000' AS loaded_at
            FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 4 = 0""",
        "article_objects_round_trip": """
            SELECT CAST(page_id AS VARCHAR) AS resolved_id, md5(html) AS article_md5, length(html) AS chars FROM pages""",
        "chunked_csv_round_trip": "SELECT doc_id, md5(text) AS text_md5, lang FROM documents",
        "dead_letter_split": """
            SELECT page_id AS resolved_id, CASE WHEN contains(html, '</body>') THEN 'ok' ELSE 'failed' END AS outcome FROM pages""",
    }


def _page_texts() -> str:
    """(page_id, text) of the pages by patterns: they hold no tables, no preformatted text and no markup in texts."""
    one_break = "li"
    blocks = "address|article|aside|blockquote|body|div|footer|h[1-6]|header|main|nav|ol|p|section|ul"
    steps = [
        (r"\s+", " "), (r"^.*?<body[^>]*>", ""), (r"<!--.*?-->", ""), (r"<(script|style)[^>]*>.*?</(script|style)>", ""),
        (r"<br[^>]*>", "\n"), (rf"</?({one_break})(\s[^>]*)?>", "\n"), (rf"</?({blocks})(\s[^>]*)?>", "\n\n"), (r"<[^>]*>", ""),
    ]
    text = "html"
    for pattern, to in steps:
        text = f"regexp_replace({text}, '{pattern}', '{to}', 'gs')"
    for name, to in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{to}', 'g')"
    for pattern, to in [*fv.TEXT_RULES, (r"^\s+|\s+$", "")]:
        replacement = to.replace("$1", "\\1")
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"SELECT page_id, html, {text} AS text FROM pages".replace("'\n'", "chr(10)").replace("'\n\n'", "chr(10) || chr(10)")


def _operators() -> dict[str, str]:
    return {
        "article_text": f"""
            SELECT page_id AS resolved_id, text, CASE WHEN length(text) > 0 THEN md5(text) END AS text_md5,
                   CAST(NULL AS VARCHAR) AS error
            FROM ({_page_texts()})""",
        "stream_archived_sources": """
            SELECT page_id, md5(html) AS html_md5, CASE WHEN page_id % 4 = 3 THEN 'drop' ELSE 'archive' END AS place FROM pages
            UNION ALL SELECT page_id, md5(html), 'read' FROM pages""",
        "stream_article_outcomes": f"""
            SELECT CAST(page_id AS BIGINT) AS resolved_id, md5(html) AS html_md5,
                   CASE WHEN contains(html, '</body>') THEN md5(text) END AS text_md5,
                   CASE WHEN NOT contains(html, '</body>') THEN 'ValueError: cut off' END AS error
            FROM ({_page_texts()})""",
        "latest_per_key": f"""
            SELECT o_custkey, o_orderkey, {_stamp("o_orderdate")} AS o_orderdate FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
        "earliest_per_key": f"""
            SELECT o_custkey, o_orderkey, {_stamp("o_orderdate")} AS o_orderdate FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
        "top_n_per_group": """
            SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 6""",
        "top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 180",
        "explode_tiles": with_views("legacy_pings") + """
            SELECT event_id, CASE WHEN week_user THEN t.i ELSE (event_id * 7 + t.i * 13) % 997 END AS tile_id,
                   CASE WHEN week_user THEN t.i WHEN event_id % 6 = 0 THEN t.i ELSE (event_id + t.i * 5) % 21 END AS position
            FROM legacy_pings CROSS JOIN (VALUES (0), (1), (2)) t(i) WHERE tile_count = 3""",
        "explode_events": with_views("nested_pings") + """
            SELECT event_id, CASE WHEN t.j = 0 THEN first_name ELSE 'impression' END AS name,
                   CAST(event_id - event_id % 4 AS VARCHAR) AS recommendation_id
            FROM nested_pings CROSS JOIN (VALUES (0), (1)) t(j)
            WHERE event_id % 11 <> 0 AND (event_id + t.j) % 3 <> 2""",
        "distinct_flag_counts": """
            SELECT l_returnflag, l_linestatus, count(DISTINCT l_suppkey) AS suppliers,
                   count(DISTINCT CASE WHEN l_quantity >= 45 THEN l_suppkey END) AS bulk_suppliers,
                   count(DISTINCT CASE WHEN l_discount >= 0.09::DOUBLE THEN l_suppkey END) AS discount_suppliers
            FROM lineitem GROUP BY 1, 2""",
        "sum_by_keys": with_views("trailing_by_item") + """
            SELECT corpus_slate_configuration_id, corpus_item_id,
                   CAST(sum(trailing_1_day_impressions) AS BIGINT) AS trailing_1_day_impressions,
                   CAST(sum(trailing_1_day_opens) AS BIGINT) AS trailing_1_day_opens
            FROM trailing_by_item WHERE corpus_item_id <> '7' GROUP BY 1, 2""",
        "left_join_filtered": """
            SELECT c_custkey AS o_custkey, c_mktsegment, o_orderkey
            FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'""",
        "without_match": """
            SELECT c_custkey AS custkey, c_name FROM customer
            LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 4 <> 1) ON o_custkey = c_custkey
            WHERE o_custkey IS NULL""",
        "union_distinct": with_views("scheduled_once", "approved_items") + """
            SELECT topic, publisher FROM scheduled_once UNION SELECT topic, publisher FROM approved_items""",
        "feature_records": with_views("trailing_by_item") + f""",
            f AS (SELECT surface_configuration_item_key AS key, strftime(updated_at_day, '{_ISO}') AS updated_at, * FROM trailing_by_item)
            SELECT key AS record_id, 'key' AS feature_name, key AS value_as_string FROM f
            UNION ALL SELECT key, 'updated_at', updated_at FROM f
            UNION ALL SELECT key, 'corpus_item_id', corpus_item_id FROM f
            UNION ALL SELECT key, 'trailing_1_day_impressions', CAST(trailing_1_day_impressions AS VARCHAR) FROM f
            UNION ALL SELECT key, 'seen', CASE WHEN trailing_1_day_opens > 1 THEN 'True' ELSE 'False' END FROM f
            UNION ALL SELECT key, 'maybe', CASE WHEN trailing_1_day_opens <> 1 THEN CAST(trailing_1_day_opens AS VARCHAR)
                                                ELSE 'None' END FROM f""",
        "chunk_rows": """
            SELECT o_orderstatus, CAST(chunk_no AS BIGINT) AS chunk_no, count(*) AS row_count, min(o_orderkey) AS first_key,
                   max(o_orderkey) AS last_key
            FROM (SELECT *, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 75 AS chunk_no FROM orders)
            GROUP BY 1, 2""",
        "iso_times": f"""
            SELECT event_id, strftime(ts, '{_ISO}') AS iso, {_stamp("date_trunc('second', ts)")} AS parsed FROM events""",
        "stream_second_clicks": f"""
            SELECT {_stamp("second")} AS second, user_id, rows, clicks FROM (
                SELECT date_trunc('second', ts) AS second, user_id, count(*) AS rows,
                       CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks
                FROM events GROUP BY 1, 2)
            WHERE clicks < 3""",
        "stream_trailing_error": f"""
            SELECT {_stamp("s")} AS window_start, {_stamp("s + INTERVAL 1 DAY")} AS window_end, kind, {_stamp("u")} AS updated_at,
                   impressions, opens, TRUE AS impressions_close, TRUE AS opens_close
            FROM (
                SELECT time_bucket(INTERVAL 6 HOURS, CAST(ts AS TIMESTAMP)) - back * INTERVAL 6 HOURS AS s, event_type AS kind,
                       max(CAST(ts AS TIMESTAMP)) AS u, count(DISTINCT user_id) FILTER (event_type <> 'click') AS impressions,
                       count(DISTINCT user_id) FILTER (event_type = 'click') AS opens
                FROM events, range(4) AS b(back) GROUP BY 1, 2)""",
        "stream_latest": f"""
            SELECT {_stamp("date_trunc('day', t)")} AS period_start, event_id, {_stamp("t")} AS ts, user_id, event_type
            FROM (SELECT *, CAST(ts AS TIMESTAMP) AS t FROM events)
            QUALIFY row_number() OVER (PARTITION BY CAST(t AS DATE), user_id ORDER BY t DESC, event_id DESC) = 1""",
        "stream_articles": f"""
            SELECT page_id AS resolved_id, md5(html) AS html_md5, TRUE AS has_text, '{AS_OF}.000000' AS loaded_at FROM pages""",
        "stream_deduplicated": "SELECT DISTINCT user_id, event_type FROM events",
    }


def oracle_sql() -> dict[str, str]:
    return (
        _telemetry() | _features() | _revenue() | _scores() | _candidates() | _user_sync() | _retention()
        | _maintenance() | _operators()
    )
