"""The sample views as DuckDB common table expressions."""

from __future__ import annotations

from ..functions import fixed_values as fv
from .rules import DUCK, TILES, view_columns

_VIEWS = view_columns(DUCK)


def _plain(view: str) -> str:
    table, columns = _VIEWS[view]
    listed = ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())
    return f"SELECT {listed} FROM {table}"


def _feed_case(country: str, locale: str) -> str:
    def listed(values) -> str:
        return ", ".join(f"'{v}'" for v in values)

    whens = " ".join(
        f"WHEN {country} IN ({listed(countries)}) AND {locale} IN ({listed(locales)}) THEN '{feed}'"
        for feed, countries, locales in fv.FEEDS
    )
    return f"CASE {whens} END"


_SPECIAL = {
    # one row per ping, de-duplicated per (day, document), with its feed
    "legacy_tiles": f"""
        SELECT p.*, CASE WHEN week_user THEN t.i ELSE (event_id * 7 + t.i * 13) % {TILES} END AS tile_id,
               CASE WHEN week_user THEN t.i WHEN event_id % 6 = 0 THEN t.i ELSE (event_id + t.i * 5) % 21 END AS position
        FROM legacy_dedup p CROSS JOIN (VALUES (0), (1), (2)) t(i) WHERE tile_count = 3""",
    "nested_events": f"""
        SELECT p.*, CASE WHEN t.j = 0 THEN first_name ELSE 'impression' END AS name,
               CASE WHEN event_id % 11 <> 0 AND (event_id + t.j) % 3 <> 2
                    THEN CAST(event_id - event_id % 4 AS VARCHAR) END AS recommendation_id,
               CASE WHEN event_id % 11 <> 0 THEN CAST((event_id * 7 + t.j * 13) % {TILES} AS VARCHAR) END AS tile_id,
               CASE WHEN event_id % 37 = 0 THEN 'x' ELSE CAST((event_id + t.j * 5) % 21 AS VARCHAR) END AS position,
               CASE WHEN event_id % 4 = 0 THEN TRUE WHEN event_id % 4 = 1 THEN NULL ELSE FALSE END AS is_sponsored
        FROM nested_dedup p CROSS JOIN (VALUES (0), (1)) t(j)""",
    "scheduled_items": "SELECT * FROM scheduled_once UNION ALL SELECT * FROM scheduled_again",
    "topics": """
        SELECT DISTINCT topic AS corpus_topic_id, 'en-' || lower(topic) AS curated_catalog_candidate_set_id,
               'de-' || lower(topic) AS german_curated_catalog_candidate_set_id,
               'legacy-' || lower(topic) AS legacy_curated_catalog_candidate_set_id
        FROM approved_items""",
    "deleted_users": "SELECT hashed_user_id, user_id FROM account_deletions WHERE is_deletion",
    "known": "SELECT hashed_user_id, user_id FROM known_users WHERE is_known",
    "known_emails": "SELECT email FROM email_map WHERE is_known",
    "score_groups": f"""
        SELECT l_suppkey AS publisher_id,
               CASE WHEN l_partkey % 2 = 0 THEN l_partkey + {fv.SCORE_MAX_SMALL_ID} ELSE l_partkey END AS content_id,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, count(*) AS lines
        FROM lineitem GROUP BY 1, 2""",
    "lifetime": """
        SELECT publisher_id, content_id,
               CASE WHEN (publisher_id + content_id) % 10 = 1 THEN 0 ELSE quantity END AS save_cnt,
               CASE WHEN (publisher_id + content_id) % 10 = 1 THEN 0 ELSE lines * 7 END AS open_cnt,
               CASE WHEN (publisher_id + content_id) % 10 = 1 THEN 0
                    WHEN (publisher_id + content_id) % 10 = 2 THEN NULL ELSE lines END AS favorite_cnt,
               CASE WHEN (publisher_id + content_id) % 10 = 1 THEN 0 ELSE lines + quantity % 5 END AS share_cnt
        FROM score_groups WHERE (publisher_id + content_id) % 10 <> 0""",
}
_NEEDS = {
    "legacy_tiles": ["legacy_dedup"],
    "nested_events": ["nested_dedup"],
    "legacy_dedup": ["legacy_pings"],
    "nested_dedup": ["nested_pings"],
    "scheduled_items": ["scheduled_once", "scheduled_again"],
    "topics": ["approved_items"],
    "deleted_users": ["account_deletions"],
    "known": ["known_users"],
    "known_emails": ["email_map"],
    "lifetime": ["score_groups"],
}


def _dedup(view: str, country: str, locale: str, where: str) -> str:
    return f"""
        SELECT *, CAST(submission_timestamp AS DATE) AS day, {_feed_case(country, locale)} AS feed_name
        FROM {view} WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY CAST(submission_timestamp AS DATE), document_id
                                   ORDER BY submission_timestamp DESC, event_id DESC) = 1"""


def with_views(*names: str, where: str = "TRUE") -> str:
    """``WITH a AS (…), b AS (…)`` for the views and what they need, needs first.

    ``where`` restricts the pings before their de-duplication.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    bodies = {
        "legacy_dedup": _dedup("legacy_pings", "normalized_country_code", "locale", where),
        "nested_dedup": _dedup("nested_pings", "normalized_country_code", "newtab_locale", where),
        **_SPECIAL,
    }
    return "WITH " + ",\n".join(f"{n} AS ({bodies.get(n) or _plain(n)})" for n in ordered)
