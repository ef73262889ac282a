"""Rules that derive input views of the jobs from the given tables.

The tables (events, documents, orders, …) lack the columns the jobs read, so each
view computes them with integer arithmetic both Spark and DuckDB evaluate alike.
A view reads its whole table. Expressions are SQL text; the few functions the
engines spell differently come from :class:`Dialect`.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..functions import fixed_values as fv

AS_OF = "2024-01-31 00:00:00"
# the domain that publisher features leave out
OWN_DOMAIN = 50
AS_OF_EPOCH = 1706659200
TILES = 997
_TOPIC_NAMES = [topic for topic, _ in fv.APPROVED_TOPICS] + [fv.EXCLUDED_TOPIC]
_PAIRS = [
    ("US", "en-US"), ("CA", "en-CA"), ("GB", "en-GB"), ("IE", "en-GB"), ("IN", "en-US"), ("DE", "de"),
    ("CH", "de-CH"), ("AT", "de-AT"), ("IT", "it"), ("FR", "fr"), ("ES", "es-ES"), ("BR", "pt-BR"),
]


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def ago(self, seconds: str) -> str:
        """The time ``seconds`` before AS_OF."""
        if self.spark:
            return f"timestamp_seconds({AS_OF_EPOCH} - ({seconds}))"
        return f"(TIMESTAMP '{AS_OF}' - to_seconds(CAST({seconds} AS BIGINT)))"

    def time(self, column: str) -> str:
        return f"CAST({column} AS TIMESTAMP)"

    def week(self, column: str) -> str:
        return f"date_trunc('week', CAST({column} AS TIMESTAMP))" if self.spark else f"date_trunc('week', {column})"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))" if self.spark else f"(({a}) // ({b}))"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")


def choose(selector: str, values) -> str:
    """CASE over 0, 1, … ; None gives NULL."""

    def text(value) -> str:
        return "NULL" if value is None else f"'{value}'"

    whens = " ".join(f"WHEN {i} THEN {text(v)}" for i, v in enumerate(values))
    return f"CASE {selector} {whens} END"


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def json_text(*pairs: tuple[str, str]) -> str:
    """Text of a JSON object from (key, SQL text expression); numbers stay quoted."""
    pieces = [f"""'"{key}":"', {value}, '"'""" for key, value in pairs]
    return "concat('{', " + ", ',', ".join(pieces) + ", '}')"


def view_columns(d: Dialect) -> dict[str, tuple[str, dict[str, str]]]:
    """View name -> (table, column -> expression)."""
    own_week = "user_id % 25 = 0"
    country = choose("user_id % 12", [c for c, _ in _PAIRS])
    locale = choose("user_id % 12", [x for _, x in _PAIRS])
    doc_pair = text("event_id - event_id % 2")
    version = f"CASE WHEN event_id % 97 = 0 THEN 'nightly' ELSE concat({text('112 + event_id % 16')}, '.0.1') END"
    channel = "CASE WHEN event_id % 10 = 9 THEN 'beta' ELSE 'release' END"
    content_of_event = d.div("event_id", "10")
    views: dict[str, tuple[str, dict[str, str]]] = {}

    views["legacy_pings"] = ("events", {
        "event_id": "event_id",
        "document_id": doc_pair,
        "submission_timestamp": f"CASE WHEN {own_week} THEN {d.week('ts')} ELSE {d.time('ts')} END",
        "client_id": text("user_id"),
        "impression_id": text("user_id"),
        "normalized_country_code": country,
        "locale": locale,
        "version": version,
        "release_channel": channel,
        "user_prefs": "CASE event_id % 5 WHEN 0 THEN 36 WHEN 1 THEN 36 WHEN 2 THEN 4 WHEN 3 THEN 32 ELSE 0 END",
        "loaded": "CASE WHEN event_id % 29 = 0 THEN 1 END",
        "click": "CASE WHEN event_type = 'click' THEN 1 END",
        "block": "CASE WHEN event_type = 'error' THEN 1 END",
        fv.LEGACY_SAVE_COLUMN: "CASE WHEN event_type = 'purchase' THEN 1 END",
        "page": f"CASE event_id % 41 WHEN 0 THEN NULL WHEN 1 THEN '{fv.EXCLUDED_PAGE}' ELSE 'about:newtab' END",
        "source": choose("event_id % 3", ["TOP_STORIES", "CARDGRID", "SPONSORED_TOPSITES"]),
        "addon_version": "CASE WHEN event_id % 13 = 0 THEN '20231201000000' ELSE '20231001000000' END",
        "tile_count": "CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 0 ELSE 3 END",
        "week_user": own_week,
    })

    views["spoc_tiles"] = ("part", {
        "tile_id": f"p_partkey % {TILES}",
        "type": "CASE WHEN p_partkey % 4 = 0 THEN 'spoc' ELSE 'organic' END",
    })

    views["nested_pings"] = ("events", {
        "event_id": "event_id",
        "document_id": doc_pair,
        "submission_timestamp": d.time("ts"),
        "normalized_country_code": country,
        "newtab_locale": locale,
        "normalized_channel": channel,
        "client_id": text("user_id"),
        "app_display_version": version,
        "section_on": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_id % 4 <> 1 END",
        "sponsored_on": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_id % 3 <> 1 END",
        "app_build": "CASE WHEN event_id % 13 = 0 THEN '20231001000000' ELSE '20231201000000' END",
        "category": f"CASE WHEN event_id % 8 = 7 THEN 'other' ELSE '{fv.NESTED_CATEGORY}' END",
        "first_name": "CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'save' "
        "WHEN 'error' THEN 'dismiss' ELSE 'impression' END",
    })

    item = {
        "approved_corpus_item_external_id": f"CASE WHEN doc_id % 211 = 17 THEN '{fv.EXCLUDED_ITEM_ID}' "
        "ELSE concat('item-', CAST(doc_id AS STRING)) END",
        "topic": choose("doc_id % 16", _TOPIC_NAMES),
        "publisher": "source",
        "content_id": "doc_id",
        "resolved_id": "doc_id + 1000000",
        "scheduled_surface_id": choose(
            f"(doc_id + {d.div('doc_id', '16')}) % 4", [fv.SURFACE_EN_US, fv.SURFACE_EN_US, fv.SURFACE_DE_DE, fv.SURFACE_DAILY_HITS]
        ),
        "is_collection": "doc_id % 5 = 0",
        "is_syndicated": "doc_id % 6 = 1",
    }
    views["approved_items"] = ("documents", {
        **item,
        "language": "upper(lang)",
        "corpus_review_status": "CASE WHEN doc_id % 7 = 0 THEN 'corpus' ELSE 'recommendation' END",
        "reviewed_corpus_item_created_at": d.ago("doc_id % 200 * 86400 + doc_id * 41 % 86400"),
        "reviewed_corpus_item_updated_at": f"CASE WHEN doc_id % 131 = 5 THEN NULL ELSE "
        f"{d.ago('doc_id % 120 * 86400 + doc_id * 37 % 86400')} END",
    })
    scheduled = {
        **item,
        "corpus_item_loaded_from": "CASE WHEN doc_id % 3 = 0 THEN 'ML' ELSE 'MANUAL' END",
    }
    views["scheduled_once"] = ("documents", {
        **scheduled, "scheduled_corpus_item_scheduled_at": d.ago("(doc_id % 30 - 3) * 86400 + doc_id * 53 % 86400"),
    })
    views["scheduled_again"] = ("documents", {
        **scheduled, "scheduled_corpus_item_scheduled_at": d.ago("(doc_id % 11 + 1) * 86400 + doc_id * 59 % 86400"),
    })
    views["content"] = ("documents", {
        "content_id": "doc_id",
        "resolved_url": f"concat('https://', source, '.example/', {text('doc_id - doc_id % 3')})",
        "top_domain_name": "CASE WHEN doc_id % 101 = 3 THEN NULL ELSE concat(source, '.example') END",
        "first_parsed_at": d.ago("doc_id % 10 * 86400 + doc_id * 43 % 86400"),
        "language": "lang",
        "word_count": "n_chars",
        "domain_id": f"CASE WHEN doc_id % 50 = 0 THEN {OWN_DOMAIN} ELSE doc_id % 50 END",
    })
    views["scheduled_content"] = ("labels", {"content_id": "CASE WHEN toxic = 1 THEN doc_id END"})
    views["engagement_by_day"] = ("events", {
        "content_id": content_of_event,
        "happened_at": d.ago("event_id * 7 % 11 * 86400"),
        "save_count": "CASE WHEN event_type IN ('purchase', 'view') THEN event_id % 4 ELSE 0 END",
        "open_count": "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END",
        "favorite_count": "CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END",
        "external_share_count": "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END",
    })
    views["syndicated_articles"] = ("documents", {
        fv.SYNDICATED_KEY: "CASE WHEN doc_id % 6 = 1 THEN doc_id + 1000000 ELSE -doc_id END",
        "domain": "concat(source, '.syndicated')",
    })
    views["recommendations"] = ("events", {
        "corpus_recommendation_id": text("event_id"),
        "tile_id": f"event_id % {TILES}",
        "hashed_user_id": f"CASE WHEN event_id % 17 = 0 THEN NULL ELSE concat('u', {text('user_id')}) END",
        "corpus_item_id": text("(user_id * 31 + event_id % 5) % 500"),
        "recommendation_surface_id": choose("event_id % 3", ["home", "newtab", None]),
        "corpus_slate_configuration_id": f"concat('slate-', {text('event_id % 4')})",
        "recommended_at": d.time("ts"),
    })
    views["impressions"] = ("events", {
        "corpus_recommendation_id": text("event_id - event_id % 2"),
        "happened_at": d.time("ts"),
    })
    views["trailing_by_item"] = ("events", {
        "surface_configuration_item_key": f"concat('home/slate/', {text('event_id')})",
        "updated_at_day": d.time("ts"),
        "recommendation_surface_id": "'home'",
        "corpus_slate_configuration_id": f"concat('slate-', {text('event_id % 4')})",
        "corpus_item_id": text("user_id"),
        **{name: f"event_id % {i + 2}" for i, name in enumerate(fv.TRAILING_COUNTERS)},
    })

    ua = json_text(
        ("useragentFamily", "event_type"), ("useragentMajor", text("event_id % 7")),
        ("osFamily", "'Linux'"), ("osMajor", text("event_id % 3")), ("osMinor", text("event_id % 5")),
    )
    ua_full = json_text(
        ("useragentFamily", "event_type"), ("useragentMajor", text("event_id % 7")),
        ("useragentMinor", text("event_id % 2")), ("osFamily", "'Linux'"), ("osMajor", text("event_id % 3")),
    )
    contexts = fv.BACKEND_CONTEXTS
    views["backend_raw"] = ("events", {
        "event_id": text("event_id - event_id % 2"),
        "collector_tstamp": d.time("ts"),
        "derived_tstamp": d.ago("event_id"),
        "app_id": choose("event_id % 3", [f"{fv.APP_PATTERN[:-1]}web", f"{fv.APP_PATTERN[:-1]}web-dev", "other-app"]),
        "event_name": "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'content_open' "
        "WHEN 'purchase' THEN 'list_item_update' WHEN 'signup' THEN 'app_open' ELSE 'object_update' END",
        "geo_city": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'Sample City' END",
        "geo_country": choose("user_id % 3", ["US", "DE", None]),
        "br_lang": choose("user_id % 2", ["en-US", None]),
        "page_urlhost": "'www.example.org'",
        "page_urlpath": choose("event_id % 5", ["/explore/x", "/de/explore/x", "/saves", "/collections/y", None]),
        "page_urlquery": "CASE WHEN event_id % 6 = 0 THEN 'a=1' END",
        contexts["agent"]: f"CASE event_id % 3 WHEN 0 THEN concat('[', {ua}, ']') "
        f"WHEN 1 THEN concat('[', {ua_full}, ']') ELSE NULL END",
        contexts["app"]: f"CASE WHEN event_id % 4 = 1 THEN concat('[', {json_text(('version', text('event_id % 9')))}, ']') END",
        contexts["api_user"]: "concat('[', " + json_text(
            ("client_version", text("event_id % 8")), ("api_id", text("event_id % 6"))) + ", ']')",
        contexts["user"]: "CASE WHEN event_id % 7 < 3 THEN concat('[', " + json_text(
            ("hashed_guid", text("user_id * 3")), ("hashed_user_id", text("user_id * 5"))) + ", ']') END",
        contexts["ui"]: "CASE WHEN event_id % 5 = 2 THEN concat('[', " + json_text(
            ("type", "'button'"), ("identifier", text("event_id % 4")), ("index", text("event_id % 12"))) + ", ']') END",
        contexts["item_update"]: "CASE WHEN event_id % 2 = 0 THEN '{\"trigger\":\"save\"}' ELSE '{\"trigger\":\"tag\"}' END",
    })

    views["curated_feed_items"] = ("documents", {
        "curated_rec_id": "doc_id", "feed_id": "doc_id % 9", "resolved_id": "doc_id + 1000000",
        "prospect_id": "doc_id * 3", "queued_id": "doc_id * 5",
        "status": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat(lang, '|', source) END",
        "time_live": f"{AS_OF_EPOCH} - doc_id * 61", "time_added": f"{AS_OF_EPOCH} - doc_id * 67",
        "time_updated": f"CASE WHEN doc_id % 10 = 0 THEN NULL ELSE {AS_OF_EPOCH} - doc_id * 71 END",
    })
    views["curated_feed_items_deleted"] = ("documents", {
        "id": "doc_id + 7", **views["curated_feed_items"][1], "deleted_user_id": "doc_id % 13",
        "deleted_at": d.ago("doc_id * 73"),
    })
    views["curated_feed_prospects"] = ("documents", {
        "prospect_id": "doc_id", "feed_id": "doc_id % 9", "resolved_id": "doc_id + 1000000",
        "type": "source", "status": "lang", "curator": "concat('\"', source, '\"')",
        "time_added": f"{AS_OF_EPOCH} - doc_id * 61", "time_updated": f"{AS_OF_EPOCH} - doc_id * 67",
        "top_domain_id": "doc_id % 50", "title": "concat(source, '|', lang, '|')",
        "excerpt": "text", "image_src": "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat('http://i/', source) END",
    })
    views["curated_feed_queued_items"] = ("orders", {
        "queued_id": "o_orderkey", "feed_id": "o_custkey % 9", "resolved_id": "o_orderkey + 1000000",
        "prospect_id": "o_orderkey * 3", "status": "o_orderstatus", "curator": "o_orderpriority",
        "relevance_length": "o_custkey % 100", "topic_id": "o_custkey % 16", "weight": "o_orderkey % 5",
        "time_added": f"{AS_OF_EPOCH} - o_orderkey", "time_updated": f"{AS_OF_EPOCH} - o_orderkey % 86400",
    })
    views["tile_source"] = ("part", {
        "tile_id": "p_partkey", "source_id": "p_partkey * 11", "type": "p_brand",
        "created_at": d.ago("p_partkey * 79"), "updated_at": d.ago("p_partkey * 31"),
    })

    views["account_deletions"] = ("customer", {
        "hashed_user_id": "CASE WHEN c_custkey % 29 = 3 THEN NULL ELSE concat('h', CAST(c_custkey AS STRING)) END",
        "user_id": "c_custkey",
        "is_deletion": "c_custkey % 3 = 0",
    })
    views["known_users"] = ("customer", {
        "hashed_user_id": "concat('h', CAST(c_custkey AS STRING))", "user_id": "c_custkey",
        "is_known": "c_custkey % 6 = 0",
    })
    views["email_map"] = ("customer", {
        "user_id": "c_custkey",
        "email": "CASE WHEN c_custkey % 31 = 9 THEN NULL ELSE concat(lower(c_name), '@x.org') END",
        "is_known": "c_custkey % 12 = 0",
    })
    views["user_orders"] = ("orders", {
        "o_orderkey": "o_orderkey",
        "user_id": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_custkey END",
        "hashed_user_id": "CASE WHEN o_orderkey % 5 = 0 THEN NULL "
        "ELSE concat('h', CAST(o_custkey + o_orderkey % 2 AS STRING)) END",
        "email": "concat('customer#', CAST(o_custkey AS STRING), '@x.org')",
        "is_deleted": "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN TRUE ELSE FALSE END",
    })
    payload = (
        "concat('{\"data\":{\"user_id\":', CAST(user_id AS STRING), ',\"user_key\":\"', CAST(user_id AS STRING), "
        "'\",\"user_key_type_id\":', CAST(event_id % 3 AS STRING), '}}')"
    )
    views["event_payloads"] = ("events", {
        "event_id": "event_id", "user_id": "user_id", "user_key_type_id": "event_id % 3",
        "event": f"CASE WHEN event_id % 19 = 0 THEN NULL ELSE {payload} END",
    })

    views["context_events"] = ("events", {
        "event_id": "event_id",
        "context": "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 2 = 0 THEN "
        "concat('[{\"hashed_user_id\":\"h', CAST(user_id AS STRING), '\"},{\"user_id\":3}]') "
        "ELSE concat('[{\"user_id\":', CAST(user_id AS STRING), '}]') END",
    })

    views["user_changes"] = ("events", {
        "event_id": text("event_id"),
        "loaded_at": d.time("ts"),
        "happened_at": d.ago("event_id * 3"),
        "user_event_trigger": "CASE WHEN event_id % 14 = 3 THEN 'account_delete' ELSE 'other' END",
        "external_id": f"CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('ext-', {text('user_id')}) END",
        "email": "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 = 1 THEN NULL "
        f"WHEN event_id % 7 = 2 THEN 'no-address' ELSE concat('user', {text('user_id')}, '@mail.org') END",
        fv.NEW_ALIAS_FLAG_COLUMN: "CASE WHEN event_id % 7 = 1 THEN FALSE WHEN event_id % 11 = 0 THEN NULL "
        "ELSE event_id % 2 = 0 END",
        "is_premium": "CASE event_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END",
        "time_zone": choose("user_id % 3", ["Europe/Paris", "America/New_York", None]),
        "country": choose("user_id % 4", ["FR", "US", "DE", None]),
        fv.USER_LOCALE_COLUMN: choose("user_id % 2", ["fr-FR", "en-US"]),
        "subscribe_to_newsletter_subscription_group_name": choose(
            "event_id % 6", [*fv.SUBSCRIPTION_GROUPS["production"], "", None, None]),
        "email_subscribe": choose("event_id % 4", ["subscribed", None, "opted_in", None]),
        fv.EVENT_NAME_COLUMN: choose("event_id % 5", [fv.SIGNUP_EVENT, "app_open", "", None, None]),
        "newsletter_signup_event_newsletter": choose("event_id % 3", ["hits", None, "weekly"]),
        "newsletter_signup_event_frequency": choose("event_id % 2", ["daily", None]),
    })
    return views
