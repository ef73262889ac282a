"""Backend events: selection, one row per event id, nested JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import like_any
from ..operators.intervals import in_interval
from ..operators.latest import latest_per_key

_AGENT = "struct<useragentFamily:string,useragentMajor:string,useragentMinor:string,osFamily:string,osMajor:string,osMinor:string>"
_CONTEXT_TYPES = {
    "agent": f"array<{_AGENT}>",
    "app": "array<struct<version:string>>",
    "api_user": "array<struct<client_version:string,api_id:string>>",
    "user": "array<struct<hashed_guid:string,hashed_user_id:string>>",
    "ui": "array<struct<type:string,component_detail:string,identifier:string,index:string>>",
    "item_update": "struct<trigger:string>",
}


def _context(name: str) -> Column:
    """First element of a JSON context array (or the one JSON object) as a struct.

    Only the read fields are parsed, all as text.
    """
    data_type = _CONTEXT_TYPES[name]
    parsed = F.from_json(F.col(fv.BACKEND_CONTEXTS[name]), data_type)
    return F.get(parsed, F.lit(0)) if data_type.startswith("array") else parsed


def event_selection() -> Column:
    """Which events are exported.

    AND binds more tightly than OR, so the tests on the application apply to page
    views alone; other events pass whatever their application.
    """
    name = F.col("event_name")
    saved = (name == "list_item_update") & (F.col("item_update.trigger") == "save")
    known_reader = F.col("user.hashed_user_id").isNotNull() | like_any("page_urlpath", fv.PAGE_PATHS)
    own_app = ~F.col("app_id").like(fv.DEV_APP_PATTERN) & F.col("app_id").like(fv.APP_PATTERN)
    page_view = (name == "page_view") & known_reader & own_app
    return saved | (name == "content_open") | (name == "app_open") | page_view


def backend_events(events: DataFrame, start, end) -> DataFrame:
    """First occurrence of each selected event with its JSON payloads.

    Null leaves are left out of the payloads. The raw contexts are reduced to the
    read fields before the de-duplication shuffles the rows.
    """
    parsed = events.filter(in_interval("collector_tstamp", start, end)).select(
        "event_id", "collector_tstamp", "derived_tstamp", "app_id", "event_name", "geo_city", "geo_country",
        "br_lang", "page_urlhost", "page_urlpath", "page_urlquery",
        *[_context(name).alias(name) for name in fv.BACKEND_CONTEXTS],
    ).filter(event_selection())
    first = latest_per_key(parsed, "event_id", "collector_tstamp", ["derived_tstamp", "app_id"], ascending=True)
    agent = "agent."
    metadata = F.struct(
        F.struct(
            F.struct(F.col("geo_city").alias("city"), F.col("geo_country").alias("country")).alias("geo"),
            F.struct(
                F.col(agent + "useragentFamily").alias("browser"),
                F.col(agent + "osFamily").alias("os"),
                F.concat(agent + "useragentMajor", agent + "useragentMinor").alias("version"),
            ).alias("user_agent"),
        ).alias("metadata")
    )
    client_info = F.struct(
        F.struct(
            F.coalesce("app.version", "api_user.client_version").alias("app_build"),
            F.col("user.hashed_guid").alias("client_id"),
            F.col("user.hashed_user_id").alias("user_id"),
            F.col("br_lang").alias("locale"),
            F.col(agent + "osFamily").alias("os"),
            F.concat(agent + "osMajor", agent + "osMinor").alias("os_version"),
        ).alias("client_info")
    )
    extras = F.struct(
        F.coalesce(F.col("api_user.api_id").cast("int"), F.lit(0)).alias("api_id"),
        F.col("page_urlhost").alias("page_url_host"),
        F.col("page_urlpath").alias("page_url_path"),
        F.col("page_urlquery").alias("page_url_query"),
        F.col("ui.type").alias("bottom_ui_type"),
        F.col("ui.component_detail").alias("bottom_ui_component_detail"),
        F.col("ui.identifier").alias("bottom_ui_identifier"),
        F.col("ui.index").cast("int").alias("bottom_ui_index"),
    )
    return first.select(
        F.col("collector_tstamp").alias("submission_timestamp"),
        F.col("derived_tstamp").alias("event_timestamp"),
        "app_id",
        F.to_json(metadata).alias("metadata"),
        F.to_json(client_info).alias("client_info"),
        F.lit(fv.BACKEND_EVENT_CATEGORY).alias("event_category"),
        "event_name",
        F.to_json(extras).alias("event_extras"),
    )
