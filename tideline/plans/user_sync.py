"""User changes as request payloads for a messaging service.

One pass turns each change into its items (at most five), the items are numbered
into chunks per endpoint, and each chunk becomes one request body. Steps must be
sent in order: alias, identify, subscribe, track, delete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import as_timestamp, empty_to_null, iso8601, mask_email, valid_email
from ..operators.checks import exactly_one_id
from ..operators.chunks import chunk_rows, collect_chunks

_STEPS = {
    "alias": (1, "/users/alias/new"),
    "identify": (2, "/users/identify"),
    "subscribe": (3, "/subscription/status/set"),
    "track": (4, "/users/track?="),
    "delete": (5, "/users/delete"),
}
_GROUP = ["step", "endpoint", "subscription_group_id"]
_SIGNUP_NEWSLETTER = "newsletter_signup_event_newsletter"
_SIGNUP_FREQUENCY = "newsletter_signup_event_frequency"
_SUBSCRIPTION = "subscribe_to_newsletter_subscription_group_name"


def clean_deltas(changes: DataFrame, last_offset, production: bool = True) -> DataFrame:
    """Changes loaded after the offset, cleaned; those that name no user are dropped.

    Outside production the addresses are masked.
    """
    email = F.col("email")
    has_email = F.when((email == "") & F.col(fv.NEW_ALIAS_FLAG_COLUMN), F.lit(False)).otherwise(
        F.col(fv.NEW_ALIAS_FLAG_COLUMN)
    )
    cleaned = changes.filter(F.col("loaded_at") > as_timestamp(last_offset)).select(
        "event_id", "loaded_at", "happened_at", "user_event_trigger",
        empty_to_null("external_id").alias("external_id"),
        (empty_to_null(email) if production else mask_email(email)).alias("email"),
        has_email.alias("has_email"),
        "is_premium", "time_zone", "country", fv.USER_LOCALE_COLUMN, _SUBSCRIPTION, "email_subscribe",
        fv.EVENT_NAME_COLUMN, _SIGNUP_NEWSLETTER, _SIGNUP_FREQUENCY,
    )
    named = cleaned.filter(F.col("email").isNotNull() | F.col("external_id").isNotNull())
    return named


def new_offset(deltas: DataFrame) -> DataFrame:
    """Latest load time as the next offset; no row for no changes."""
    latest = deltas.agg(F.max("loaded_at").cast("string").alias("last_offset"))
    return latest.filter(F.col("last_offset").isNotNull())


def _alias_name() -> Column:
    return F.when(
        F.col("email").isNull(), F.raise_error(F.concat(F.lit("alias without email: "), "event_id"))
    ).otherwise(F.col("email"))


def _alias_only() -> Column:
    """The alias object, for users without external id."""
    alias = F.struct(F.lit(fv.ALIAS_LABEL).alias("alias_label"), F.col("email").alias("alias_name"))
    return F.when(F.col("external_id").isNull(), alias)


def _one_id() -> Column:
    """The external id; a user object without id and alias, or with both, fails the job."""
    alias = _alias_only()
    wrong = F.raise_error(F.concat(F.lit("not exactly one identifier: "), "event_id")).cast("string")
    return F.when(exactly_one_id(F.col("external_id"), alias["alias_name"]), F.col("external_id")).otherwise(wrong)


def attributes_json() -> Column:
    return F.to_json(
        F.struct(
            _one_id().alias("external_id"),
            _alias_only().alias("user_alias"),
            F.lit(True).alias("_update_existing_only"),
            F.col("email"),
            F.col("email_subscribe"),
            F.col("country"),
            F.col("time_zone"),
            F.col("is_premium"),
            F.col(fv.USER_LOCALE_COLUMN),
        )
    )


def event_json() -> Column:
    """The named event of a change; null for changes without event."""
    name = F.col(fv.EVENT_NAME_COLUMN)
    given = F.map_filter(
        F.create_map(
            F.lit("newsletter"), F.col(_SIGNUP_NEWSLETTER), F.lit("frequency"), F.col(_SIGNUP_FREQUENCY)
        ),
        lambda key, value: value.isNotNull(),
    )
    nothing = F.map_filter(given, lambda key, value: F.lit(False))
    event = F.to_json(
        F.struct(
            _one_id().alias("external_id"),
            _alias_only().alias("user_alias"),
            name.alias("name"),
            iso8601("happened_at").alias("time"),
            F.when(name == fv.SIGNUP_EVENT, given).otherwise(nothing).alias("properties"),
        )
    )
    return F.when(name != "", event)


def _subscription_group(environment: str) -> Column:
    """Id of the subscription group; an unknown name fails the job."""
    name = F.col(_SUBSCRIPTION)
    known = F.lit(None).cast("string")
    for group, group_id in fv.SUBSCRIPTION_GROUPS[environment].items():
        known = F.when(name == group, group_id).otherwise(known)
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown subscription group: "), name)).cast("string"))


def _wanted() -> dict[str, Column]:
    """Which items a change gives."""
    return {
        "alias": F.col("has_email"),
        "identify": F.col("has_email"),
        "subscribe": F.col(_SUBSCRIPTION) != "",
        "track": F.lit(True),
        "delete": F.col("user_event_trigger") == fv.DELETE_TRIGGER,
    }


def _inline_items(deltas: DataFrame, environment: str, parts: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per item: step, endpoint, group and its JSON parts."""

    def item(kind: str, wanted: Column) -> Column:
        step, endpoint = _STEPS[kind]
        fields = [
            F.lit(step).alias("step"),
            F.lit(endpoint).alias("endpoint"),
            (_subscription_group(environment) if kind == "subscribe" else F.lit("")).alias("subscription_group_id"),
        ]
        main, extra = parts[kind]
        fields += [main.alias("main"), extra.alias("extra")]
        return F.when(F.coalesce(wanted, F.lit(False)), F.struct(*fields))

    items = F.array_compact(F.array(*[item(kind, wanted) for kind, wanted in _wanted().items()]))
    return deltas.select("event_id", "loaded_at", F.inline(items))


def _json_string(column: Column, wanted: Column) -> Column:
    """A text as JSON string, quotes and escapes included."""
    listed = F.to_json(F.array(column))
    return F.when(wanted, F.substring(listed, F.lit(2), F.length(listed) - 2))


def delta_items(deltas: DataFrame, environment: str = "production") -> DataFrame:
    """One row per item to send: its step, endpoint, group and JSON parts.

    ``main`` and ``extra`` are the parts of the two arrays of a request; a null part
    is left out of its array.
    """
    label = F.lit(fv.ALIAS_LABEL).alias("alias_label")
    external_id, email = F.col("external_id"), F.col("email")
    nothing = F.lit(None).cast("string")
    alias_json = F.to_json(F.struct(label, _alias_name().alias("alias_name"), external_id))
    identify_json = F.to_json(
        F.struct(external_id, F.struct(label, _alias_name().alias("alias_name")).alias("user_alias"))
    )
    id_text = _json_string(external_id, external_id.isNotNull())
    email_text = _json_string(email, external_id.isNull() & valid_email(email))
    parts = {
        "alias": (alias_json, nothing),
        "identify": (identify_json, nothing),
        "subscribe": (id_text, email_text),
        "track": (attributes_json(), event_json()),
        "delete": (id_text, nothing),
    }
    return _inline_items(deltas, environment, parts)


def user_delta_payloads(deltas: DataFrame, environment: str = "production") -> DataFrame:
    """One row per request, in the order of the steps."""
    items = delta_items(deltas, environment)
    limit = F.when(F.col("step") == _STEPS["track"][0], fv.TRACK_LIMIT).otherwise(fv.OTHER_LIMIT)
    order = [F.asc("loaded_at"), F.asc("event_id")]
    chunked = chunk_rows(items, limit, _GROUP, order, ["event_id"])
    rows = collect_chunks(chunked, _GROUP, {"main": F.col("main"), "extra": F.col("extra")})

    def listed(column: str) -> Column:
        return F.concat(F.lit("["), F.array_join(column, ","), F.lit("]"))

    def named(key: str, column: str) -> Column:
        return F.concat(F.lit(f'"{key}":'), listed(column))

    def unless_empty(key: str, column: str) -> Column:
        return F.when(F.size(column) > 0, F.concat(F.lit(","), named(key, column))).otherwise(F.lit(""))

    subscription = F.concat(
        F.lit('{"subscription_group_id":"'), F.col("subscription_group_id"),
        F.lit('","subscription_state":"subscribed"'),
        unless_empty("external_id", "main"), unless_empty("email", "extra"), F.lit("}"),
    )

    def body(*parts: Column) -> Column:
        separated = [piece for part in parts for piece in (part, F.lit(","))][:-1]
        return F.concat(F.lit("{"), *separated, F.lit("}"))

    step = F.col("step")
    payload = (
        F.when(step == 1, body(named("user_aliases", "main")))
        .when(step == 2, body(named("aliases_to_identify", "main")))
        .when(step == 3, subscription)
        .when(step == 4, body(named("attributes", "main"), named("events", "extra")))
        .otherwise(body(named("external_ids", "main")))
    )
    return rows.select(*_GROUP, "chunk_no", "row_count", payload.alias("payload"))


def ordered_payloads(payloads: DataFrame) -> DataFrame:
    return payloads.orderBy("step", "subscription_group_id", "chunk_no")
