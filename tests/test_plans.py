"""Golden results of single jobs."""

import datetime
import json
import math
import uuid
from pathlib import Path

import numpy as np
import pytest
from cases import SF_DIR, plan_of, rows_of
from pyspark.sql import functions as F

from tideline import session
from tideline.functions import expr
from tideline.functions import fixed_values as fv
from tideline.functions import beta
from tideline.functions.beta import beta_quantile_column, log_gamma, regularised_beta
from tideline.operators.checks import corpus_item_violations, exactly_one_id, legacy_item_violations, require_none
from tideline.plans import articles, candidates, engagement, feeds, retention, revenue, score, telemetry_legacy, user_sync
from tideline.plans.publisher import finish_features
from tideline.sample import catalog as catalog_queries
from tideline.session import shared_dir
from tideline.sources import files, records
from tideline.sources.paths import subfolders
from tideline.sources.tables import chunked_csv

ENGAGEMENT = (
    "updated_at string, key string, recommendation_surface_id string, corpus_slate_configuration_id string, "
    "corpus_item_id string, trailing_1_day_impressions bigint, trailing_1_day_opens bigint"
)


def test_engagement_of_two_sources(frame):
    first = frame(ENGAGEMENT, ("1", "1", "r1", "s1", "foo1", 100, 1), ("2", "2", "r1", "s1", "foo2", 200, 2))
    second = frame(ENGAGEMENT, ("2", "2", "r1", "s1", "foo2", 300, 3), ("3", "3", "r1", "s1", "foo3", 400, 4),
                   ("3", None, "r1", "s1", "foo3", 7, 7))
    result = engagement.sum_engagement(first.unionByName(second))
    assert result.columns == fv.ENGAGEMENT_KEY + fv.TRAILING_COUNTERS
    zeros = (0,) * 8
    assert rows_of(result) == [
        ("1", "1", "r1", "s1", "foo1", 100, 1, *zeros),
        ("2", "2", "r1", "s1", "foo2", 500, 5, *zeros),
        ("3", "3", "r1", "s1", "foo3", 400, 4, *zeros),
    ]


SCORES = {
    "open_uv": 10.65, "open_dv": 8.8, "fav_uv": 7.36, "fav_dv": 10.8, "share_uv": 6.36, "share_dv": 11.8,
    "open_score": 0.4030977202751753, "favorite_score": 0.2616197979289548, "share_score": 0.2123843082052466,
    "total_score": 0.2459912974889750,
}


def test_content_scores_and_their_routing(frame):
    keys = [(1, 2147483646), (1, 2147483647), (2, 2147483648), (2, 2147483645), (3, 2147483644), (4, 1), (5, 1), (6, 1)]
    queue = frame("publisher_id bigint, content_id bigint", *keys)
    counters = [(*k, "9", "8", "7", "6") for k in keys[:5]] + [(4, 1, "0", "0", "0", "0"), (5, 1, "3", None, "1", "1")]
    lifetime = frame(
        "publisher_id bigint, content_id bigint, save_cnt string, open_cnt string, favorite_cnt string, share_cnt string",
        *counters,
    )
    scores = score.content_score(score.content_score_inputs(queue, lifetime))
    for row in scores.collect():
        for name, value in SCORES.items():
            assert row[name] == pytest.approx(value, abs=1e-12)
    assert scores.count() == 5
    empty = scores.limit(0)
    small, large, left = score.load_scores(empty, empty, queue, scores)
    assert small.count() == 4 and rows_of(large, "content_id", "total_score") == [(2147483648, 0.246)]
    assert rows_of(left) == [(4, 1), (5, 1), (6, 1)]
    again = score.load_scores(small, large, queue, scores)
    assert again[0].count() == 4 and again[1].count() == 1


def test_score_inputs_with_more_hits_than_tries(frame):
    queue = frame("publisher_id bigint, content_id bigint", (1, 1))
    lifetime = frame("publisher_id bigint, content_id bigint, save_cnt int, open_cnt int, favorite_cnt int, share_cnt int", (1, 1, 1, 5, 9, 9))
    row = score.content_score_inputs(queue, lifetime).first()
    assert row["open_dv"] == pytest.approx(((1 - 5) + 7.8 + row["open_uv"]) * 4)
    assert row["fav_dv"] == pytest.approx(((5 - 9) + 9.8 + row["fav_uv"]) * 4)


def test_score_batch_is_cut_from_the_queue(frame):
    queue = frame("publisher_id bigint, content_id bigint", (2, 1), (1, 2), (1, 1))
    lifetime = frame("publisher_id bigint, content_id bigint, save_cnt int, open_cnt int, favorite_cnt int, share_cnt int",
                     *[(p, c, 1, 1, 1, 1) for p, c in ((2, 1), (1, 2), (1, 1))])
    assert rows_of(score.content_score_inputs(queue, lifetime, limit=2), *score.KEYS) == [(1, 1), (1, 2)]


def test_queue_move(frame):
    queue, holding = frame("publisher_id int, content_id int", (1, 1)), frame("publisher_id int, content_id int", (1, 1), (2, 2), (2, 2))
    moved, emptied = score.move_to_queue(queue, holding)
    assert rows_of(moved) == [(1, 1), (2, 2)] and emptied.isEmpty()


def test_quantiles_invert_the_distribution(frame):
    rows = [(0.2, 9.8), (1e6, 2e6), (5e7, 1e3), (2.2, 3.0), (0.5, 0.5), (30.0, 0.7), (0.2, 1e5), (1.0, 1.0), (2.0, 1.0), (1.0, 3.0)]
    solved = frame("a double, b double", *rows, (None, 1.0), (1.0, None)).withColumn("q", beta_quantile_column("a", "b", 0.1))
    assert "Python" not in plan_of(solved)
    back = solved.filter("q IS NOT NULL").withColumn("i", regularised_beta(F.col("a"), F.col("b"), F.col("q"))).collect()
    assert len(back) == 10 and [r["i"] for r in back] == pytest.approx([0.1] * 10, abs=1e-7)
    assert [r["q"] for r in back[-3:]] == pytest.approx([0.1, 0.1**0.5, 1 - 0.9 ** (1 / 3)], abs=1e-13)
    # Against a sum over the density.
    for r in (back[0], back[3], back[4]):
        t = (np.arange(2_000_000) + 0.5) / 2_000_000
        # With t ** (1 / a) the density has no pole at zero.
        weight = (1 - t ** (1 / r["a"])) ** (r["b"] - 1)
        assert weight[t <= r["q"] ** r["a"]].sum() / weight.sum() == pytest.approx(0.1, abs=1e-3)


def test_log_gamma(frame):
    values = [1e-6, 0.2, 0.5, 1.0, 2.0, 3.7, 10.0, 171.5, 1e5, 1e8]
    found = [r[0] for r in frame("x double", *[(v,) for v in values]).select(log_gamma(F.col("x"))).collect()]
    assert found == pytest.approx([math.lgamma(v) for v in values], rel=1e-12, abs=1e-13)


def test_quantile_that_does_not_converge_fails(frame, monkeypatch):
    monkeypatch.setattr(beta, "_STEPS", 2)
    with pytest.raises(Exception, match="does not converge"):
        frame("a double, b double", (0.2, 1e5)).select(beta_quantile_column("a", "b", 0.1)).collect()


def test_score_tables(spark, frame):
    """Scores go to their table, replace what it holds, and leave the queue."""
    counts = "publisher_id bigint, content_id bigint, save_cnt bigint, open_cnt bigint, favorite_cnt bigint, share_cnt bigint"
    big = fv.SCORE_MAX_SMALL_ID + 1
    queue = frame("publisher_id bigint, content_id bigint", (1, 1), (1, big), (2, 2), (3, 3))
    lifetime = frame(counts, (1, 1, 10, 5, 1, 1), (1, big, 0, 3, 0, 0), (2, 2, 0, 0, 0, 0), (4, 4, 1, 1, 1, 1))
    scores = score.content_score(score.content_score_inputs(queue, lifetime))
    empty = scores.limit(0)
    small, large, left = score.load_scores(empty, empty, queue, scores)
    assert rows_of(small, "publisher_id", "content_id") == [(1, 1)] and rows_of(large, "content_id") == [(big,)]
    assert rows_of(left, "publisher_id", "content_id") == [(2, 2), (3, 3)]
    row = small.first()
    assert row["open_score"] == round(row["open_score"], 4) and 0 < row["total_score"] < 1
    again = scores.withColumn("total_score", F.lit(0.123456))
    assert rows_of(score.load_scores(small, large, left, again)[0], "total_score") == [(0.1235,)]


# --- articles --------------------------------------------------------------------------
HTML = """<html><head><title>no</title><style>p{}</style></head><body><h1>Big  title</h1>
<p>One <b>bold</b> &amp; <a href='x'>link</a>.</p><script>var a;</script><hr/><ul><li>first</li><li>second</li></ul>
<table><tr><td>a</td><td>b</td></tr></table><p>   </p><p># 1 rule</p></body></html>"""


def test_article_text(frame):
    rows = frame("resolved_id string, article string", ("1", HTML), ("2", ""), ("3", None))
    found = {r["resolved_id"]: r for r in articles.extract_article_text(rows).collect()}
    lines = [line for line in found["1"]["text"].split("\n") if line]
    assert lines == ["Big title", "One bold & link.", "first", "second", "a", "b", "1 rule"]
    assert len(found["1"]["text_md5"]) == 32
    assert found["2"]["text"] == "" and found["2"]["text_md5"] is None
    assert found["3"]["text"] == "None"


def test_failed_rows_are_loaded_and_dead_lettered(frame):
    def convert(html):
        raise ValueError("bad")

    rows = frame("resolved_id string, article string, object_key string", ("7", "<p>x</p>", "k1"), ("x", "<p>y</p>", "k2"))
    extracted = articles.extract_article_text(rows, convert)
    assert rows_of(articles.content_rows(extracted.filter("resolved_id = '7'"), "2024-01-01 00:00:00"), "html", "text", "text_md5") == [
        ("<p>x</p>", None, None)
    ]
    failures = articles.failure_rows(extracted, "id", "name", 4, "2024-01-01 00:00:00")
    assert rows_of(failures, "batch_id", "resolved_id", "object_key", "error") == [
        (4, 7, "k1", "ValueError: bad"), (4, None, "k2", "ValueError: bad"),
    ]


def test_ordered_table_grows_and_is_compacted(frame):
    schema = "resolved_id bigint, html string, text string, text_md5 string, loaded_at timestamp"

    def at(hour):
        return datetime.datetime(2024, 1, 2, hour)

    content = frame(schema, (2, "h", "t2", "m", at(1)), (1, "h", "t1", "m", at(2)), (2, "h", "t3", "m", at(3)),
                    (3, "h", "old", "m", datetime.datetime(2023, 12, 1)))
    empty = frame(schema + ", last_ordered timestamp")
    first = articles.new_ordered_rows(content, empty, "2024-01-02 12:00:00")
    assert [int(r["resolved_id"]) for r in first.coalesce(1).collect()] == [1, 2, 2]
    assert articles.new_ordered_rows(content, first, "2024-01-02 12:00:00").isEmpty()
    compact = articles.compact_ordered(first, "2024-01-02 12:00:00")
    assert rows_of(compact, "text") == [("t1",), ("t3",)]
    assert compact.filter("last_ordered IS NULL").isEmpty()


def test_nothing_to_stage_is_an_error(spark):
    with pytest.raises(ValueError, match="nothing to stage"):
        chunked_csv(spark.range(0), shared_dir(spark, "csv"))


def test_no_objects_is_an_error(spark):
    folder = shared_dir(spark, "no-objects")
    spark.createDataFrame([], "resolved_id string, article string").write.json(folder)
    with pytest.raises(ValueError, match="no files to process"):
        files.ndjson_objects(spark, folder)


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,name\n1,a\nx,b\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|CAST_INVALID"):
        files.header_csv(spark, str(tmp_path / "bad.csv"), "id int, name string").collect()


# --- user sync ---------------------------------------------------------------------------
CHANGES = (
    f"event_id string, loaded_at timestamp, happened_at timestamp, user_event_trigger string, external_id string, "
    f"email string, {fv.NEW_ALIAS_FLAG_COLUMN} boolean, is_premium boolean, country string, time_zone string, "
    f"{fv.USER_LOCALE_COLUMN} string, subscribe_to_newsletter_subscription_group_name string, email_subscribe string, "
    f"{fv.EVENT_NAME_COLUMN} string, newsletter_signup_event_newsletter string, newsletter_signup_event_frequency string"
)


def _changes(spark):
    """100 changes; 5-24 sign up for a newsletter, of which 5-14 delete their account."""
    group = next(iter(fv.SUBSCRIPTION_GROUPS["development"]))
    plain = spark.range(100).selectExpr(
        "lpad(CAST(id AS STRING), 3, '0') AS event_id",
        "TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS loaded_at",
        "TIMESTAMP'2023-12-31 10:00:00' AS happened_at",
        "CASE WHEN id BETWEEN 5 AND 14 THEN 'account_delete' ELSE 'account_signup' END AS user_event_trigger",
        "CASE WHEN id BETWEEN 5 AND 14 THEN NULL ELSE 'ext' END AS external_id",
        "'test@example.com' AS email",
        f"id NOT BETWEEN 5 AND 14 AS {fv.NEW_ALIAS_FLAG_COLUMN}",
        "CAST(NULL AS BOOLEAN) AS is_premium", "'FR' AS country", "'Europe/Paris' AS time_zone",
        f"'fr-FR' AS {fv.USER_LOCALE_COLUMN}",
        f"CASE WHEN id BETWEEN 5 AND 24 THEN '{group}' END AS subscribe_to_newsletter_subscription_group_name",
        "CAST(NULL AS STRING) AS email_subscribe",
        f"CASE WHEN id BETWEEN 5 AND 24 THEN '{fv.SIGNUP_EVENT}' END AS {fv.EVENT_NAME_COLUMN}",
        "CASE WHEN id < 10 THEN 'hits' END AS newsletter_signup_event_newsletter",
        "CAST(NULL AS STRING) AS newsletter_signup_event_frequency",
    )
    return group, plain


def test_payloads(spark):
    group, changes = _changes(spark)
    deltas = user_sync.clean_deltas(changes, "2023-01-01 00:00:00")
    rows = user_sync.ordered_payloads(user_sync.user_delta_payloads(deltas, "development")).collect()
    assert [(r["step"], r["row_count"]) for r in rows] == [(1, 50), (1, 40), (2, 50), (2, 40), (3, 20), (4, 75), (4, 25), (5, 10)]
    bodies = [json.loads(r["payload"]) for r in rows]
    assert bodies[0]["user_aliases"][0] == {"alias_label": "email", "alias_name": "test@example.com", "external_id": "ext"}
    assert bodies[2]["aliases_to_identify"][0] == {
        "external_id": "ext", "user_alias": {"alias_label": "email", "alias_name": "test@example.com"},
    }
    assert bodies[4] == {
        "subscription_group_id": fv.SUBSCRIPTION_GROUPS["development"][group], "subscription_state": "subscribed",
        "external_id": ["ext"] * 10, "email": ["test@example.com"] * 10,
    }
    assert bodies[5]["attributes"][0] == {
        "external_id": "ext", "_update_existing_only": True, "email": "test@example.com", "country": "FR",
        "time_zone": "Europe/Paris", fv.USER_LOCALE_COLUMN: "fr-FR",
    }
    assert bodies[5]["attributes"][5]["user_alias"] == {"alias_label": "email", "alias_name": "test@example.com"}
    assert "external_id" not in bodies[5]["attributes"][5]
    assert len(bodies[5]["events"]) == 20 and bodies[6]["events"] == []
    assert bodies[5]["events"][0]["properties"] == {"newsletter": "hits"}
    assert bodies[5]["events"][19]["properties"] == {}
    assert bodies[5]["events"][0]["time"] == "2023-12-31T10:00:00Z"
    assert bodies[7] == {"external_ids": []}


def test_empty_lists_are_left_out_of_subscriptions(spark):
    _, changes = _changes(spark)
    nobody = changes.filter("event_id = '006'").withColumn("email", F.lit("invalid"))
    rows = user_sync.user_delta_payloads(user_sync.clean_deltas(nobody, "2023-01-01 00:00:00"), "development").collect()
    body = next(json.loads(r["payload"]) for r in rows if r["step"] == 3)
    assert set(body) == {"subscription_group_id", "subscription_state"}


def test_bad_changes_fail(spark):
    _, changes = _changes(spark)
    one = changes.filter("event_id = '020'")
    no_email = user_sync.clean_deltas(one.withColumn("email", F.lit(None).cast("string")), "2023-01-01 00:00:00")
    with pytest.raises(Exception, match="alias without email"):
        user_sync.user_delta_payloads(no_email, "development").collect()
    unknown = one.withColumn("subscribe_to_newsletter_subscription_group_name", F.lit("UNKNOWN"))
    with pytest.raises(Exception, match="unknown subscription group"):
        user_sync.user_delta_payloads(user_sync.clean_deltas(unknown, "2023-01-01 00:00:00"), "development").collect()


def test_changes_without_user_are_dropped_and_offsets(spark):
    _, changes = _changes(spark)
    nobody = changes.withColumn("email", F.lit("")).withColumn("external_id", F.lit(""))
    deltas = user_sync.clean_deltas(nobody, "2023-01-01 00:00:00")
    assert deltas.isEmpty() and user_sync.new_offset(deltas).isEmpty()
    some = user_sync.clean_deltas(changes, "2024-01-01 00:01:30")
    assert some.count() == 9
    assert user_sync.new_offset(some).first()[0].startswith("2024-01-01 00:01:39")


# --- records and messages ------------------------------------------------------------------
def test_feature_record(frame):
    df = frame("id string, clicks bigint", ("foobar-1", 200), ("foobar-2", 300))
    record = records.feature_record_json(df).first()[0]
    assert json.loads(record) == [
        {"FeatureName": "id", "ValueAsString": "foobar-1"}, {"FeatureName": "clicks", "ValueAsString": "200"},
    ]
    assert rows_of(records.feature_records(df.limit(1), "id")) == [
        ("foobar-1", "clicks", "200"), ("foobar-1", "id", "foobar-1"),
    ]


@pytest.mark.parametrize(
    "value", [0.0, 1.0, -2.5, 0.1, 123456789.125, 1e7, 12345678.9, 1e15, 1e16, 1.5e22, 1e-4, 0.000123, 1e-5, 2.5e-7, -1e-10, 1e300,
              float("nan"), float("inf"), -float("inf")],
)
def test_numbers_read_as_python_prints_them(frame, value):
    df = frame("x double", (value,))
    assert df.select(expr.python_str("x", "double")).first()[0] == str(value)


def test_null_and_boolean_read_as_python_prints_them(frame):
    df = frame("x string, b boolean", (None, True))
    assert tuple(df.select(expr.python_str("x", "string"), expr.python_str("b", "boolean")).first()) == ("None", "True")


def test_delivery_retries(spark, tmp_path):
    log = str(tmp_path / "log")

    def post(batch):
        with open(log, "a") as f:
            f.write(f"{len(batch)}\n")
        raise RuntimeError("down")

    with pytest.raises(Exception, match="down"):
        records.deliver(spark.range(3).coalesce(1), post, batch_size=2)
    assert open(log).read().split() == ["2", "2", "2"]


def test_messages_check_their_sets(frame):
    schema = "candidate_set_id string, feed_id bigint, id bigint, publisher string, recency int"
    good = frame(schema, ("00000000-0000-4000-8000-000000000016", 1, 5, "p", 1), ("00000000-0000-4000-8000-000000000016", None, 6, "p", 2))
    arguments = ([F.desc("recency")], ["id"], "flow", "run", 100)
    message = json.loads(records.candidate_messages(good, *arguments).first()["message"])
    assert message["expires_at"] == 100 + 86400 * 28 and message["version"] == 3
    assert message["candidates"] == [
        {"item_id": 6, "publisher": "p", "feed_id": None}, {"item_id": 5, "publisher": "p", "feed_id": 1},
    ]
    with pytest.raises(Exception, match="no feed_id"):
        records.candidate_messages(good, *arguments, curated=True).collect()
    with pytest.raises(Exception, match="not a UUID"):
        records.candidate_messages(frame(schema, ("x", 1, 5, "p", 1)), *arguments).collect()
    with pytest.raises(ValueError, match="expiry"):
        records.candidate_messages(good, *arguments, expires_in_s=0)
    set_id = "00000000-0000-4000-8000-000000000016"
    for publisher in (None, ""):
        with pytest.raises(Exception, match="no publisher of item 7"):
            records.candidate_messages(frame(schema, (set_id, 1, 7, publisher, 1)), *arguments).collect()
    with pytest.raises(Exception, match="has no id"):
        records.candidate_messages(frame(schema, (set_id, 1, None, "p", 1)), *arguments).collect()
    assert records.candidate_messages(good, *arguments, sets=[set_id]).count() == 1
    with pytest.raises(Exception, match="no items in set 00000000-0000-4000-8000-000000000017"):
        records.candidate_messages(good, *arguments, sets=[set_id, set_id[:-1] + "7"]).collect()


def test_purge_rules(spark, frame):
    users = frame("hashed_user_id string, user_id bigint", ("h1", 1), (None, 2), ("h3", None))
    keys = retention.account_keys(users, frame("email string", ("a@x",), (None,)))
    assert rows_of(keys) == [("email", "a@x"), ("hashed_user_id", "h1"), ("hashed_user_id", "h3"), ("user_id", "1"), ("user_id", "2")]
    rows = frame(
        "n int, user_id string, email string, event string, context string",
        (1, "1", None, '{"u":1,"t":1}', None), (2, "5", "a@x", '{"u":2,"t":2}', '[{"h":"h3"},{"h":"no"}]'),
        (3, None, "b@x", None, '[{"h":"no"},{"h":"h3"}]'), (4, "2", "a@x", "{broken", "[]"), (5, "h1", "1", '{"u":null}', '{"h":"h3"}'),
    )

    def left(*arguments, **options):
        return [r[0] for r in rows_of(retention.purge_table(rows, retention.Rule(*arguments, **options), keys), "n")]

    assert left((("user_id", "user_id"),)) == [2, 3, 5]
    assert left((("user_id", "user_id"), ("email", "email"))) == [3, 5]
    assert left((("$.u", "user_id"),)) == [3, 4, 5]
    assert left((("$.u", "user_id"),), only_if=("$.t", 1)) == [2, 3, 4, 5]
    assert left((("$[0].h", "hashed_user_id"),), payload="context") == [1, 3, 4, 5]
    purged = retention.purge_table(rows, retention.Rule((("user_id", "user_id"),)), keys)
    assert purged.columns == rows.columns and "Exchange hashpartitioning" not in plan_of(purged)
    with pytest.raises(KeyError, match="'t'"):
        retention.purge_deleted_accounts({}, {"t": retention.Rule(())}, {}, users, frame("user_id bigint, email string"), users, frame("email string"))


# --- candidates ------------------------------------------------------------------------------
def test_configs(frame):
    schema = (
        "corpus_topic_id string, curated_catalog_candidate_set_id string, german_curated_catalog_candidate_set_id string"
    )
    topics = frame(schema, ("BUSINESS", "a", "b"), ("CORONAVIRUS", "c", "d"))
    configs = candidates.candidate_configs(topics)
    assert configs.count() == 11
    rows = {r["candidate_set_id"]: r for r in configs.collect()}
    assert rows["d"]["name"] == "de_de/coronavirus" and rows["d"]["min_item_count"] == 0
    assert rows["a"]["name"] == "en_us/business" and rows["a"]["scheduled_surface_id"] == fv.SURFACE_EN_US
    assert rows["a"]["min_item_count"] == 1


def test_topics_per_set_differ(frame):
    schema = (
        "approved_corpus_item_external_id string, topic string, publisher string, scheduled_surface_id string, "
        "is_syndicated boolean, is_collection boolean, corpus_review_status string, reviewed_corpus_item_updated_at timestamp"
    )
    items = [(f"i{n}", "T", "p", "S", False, False, "recommendation", None) for n in range(6)]
    approved = frame(schema, *items)
    scheduled = frame(
        "approved_corpus_item_external_id string, topic string, publisher string, scheduled_surface_id string, "
        "is_syndicated boolean, is_collection boolean, corpus_item_loaded_from string, scheduled_corpus_item_scheduled_at timestamp"
    )
    sets = [{"candidate_set_id": "x", "scheduled_surface_id": "S", "n_per_topic": 2},
            {"candidate_set_id": "y", "scheduled_surface_id": "S", "n_per_topic": 4}]
    found = candidates.recommended_by_recency(approved, scheduled, "2024-01-01 00:00:00", sets)
    assert rows_of(found.groupBy("candidate_set_id").count()) == [("x", 2), ("y", 4)]


# --- revenue, feeds, publisher -----------------------------------------------------------------
def test_revenue_pages(spark, frame):
    data = "data array<map<string,string>>"
    pages = frame(data, ([{"Current.record_date": "2024-01-01", "Current.impressions": "5", "Current.size": "s"}],))
    archived = frame(data, ([{"Archived.record_date": "2024-01-02", "Archived.net_cpm": "0.5"}],))
    row = revenue.revenue_rows(pages).first()
    assert (str(row["record_date"]), row["impressions"], row["size"], row["browser"]) == ("2024-01-01", 5, "s", None)
    old = revenue.revenue_rows(archived, archived=True)
    assert old.first()["net_cpm"] == 0.5 and old.columns == [n for n, _ in fv.REVENUE_COLUMNS]
    days = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-01-03')) AS day")
    assert [str(r["day"]) for r in revenue.days_without_rows(days, revenue.revenue_rows(pages)).collect()] == ["2024-01-03"]


def test_revenue_load_of_missing_days(spark, frame):
    root = shared_dir(spark, "landed")
    for day in ("2024-01-02", "2024-01-03"):
        record = [{"Current.record_date": day, "Current.impressions": "5"}] * 3
        frame("data array<map<string,string>>", (record,)).write.json(f"{root}/{day}")
    table = revenue.revenue_table(spark, shared_dir(spark, "revenue"))
    bounds = ("2024-01-02 00:00:00", "2024-01-03 00:00:00")
    for _ in range(2):  # nothing is missing the second time
        loaded = revenue.load_missing_days(spark, table, lambda day: f"{root}/{day}", "2024-01-04 00:00:00", *bounds)
        assert rows_of(loaded.groupBy("record_date").count(), "count") == [(3,), (3,)]
    again = revenue.load_missing_days(spark, table, lambda day: f"{root}/{day}", "2024-01-04 00:00:00", *bounds, overwrite=True)
    assert again.count() == 6 and len(table.loads()) == 2
    frame("data array<map<string,string>>", ([],)).write.json(f"{root}/2024-01-04")
    with pytest.raises(ValueError, match="days without any record"):
        revenue.load_missing_days(spark, table, lambda day: f"{root}/{day}", "2024-01-05 00:00:00", "2024-01-04 00:00:00")
    assert table.read().count() == 6


def test_revenue_load_writes_its_batch_once(spark, frame, monkeypatch):
    base = shared_dir(spark, "revenue-once")
    monkeypatch.setattr(session, "shared_dir", lambda _, name: f"{base}/kept/{name}")
    frame("data array<map<string,string>>", ([{"Current.record_date": "2024-01-02", "Current.impressions": "5"}],)).write.json(f"{base}/pages")
    table = revenue.revenue_table(spark, f"{base}/table")
    bounds = ("2024-01-02 00:00:00", "2024-01-02 00:00:00")
    loaded = revenue.load_missing_days(spark, table, lambda day: f"{base}/pages", "2024-01-04 00:00:00", *bounds)
    assert rows_of(loaded, "impressions") == [(5,)] and subfolders(spark, f"{base}/kept") == []


def test_revenue_load_keeps_its_pages_small(spark, monkeypatch, tmp_path):
    """Pages land compressed; what was written on the way to them is gone once they have."""
    for module in (session, catalog_queries):
        monkeypatch.setattr(module, "shared_dir", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    loaded = catalog_queries.queries()["revenue_load"](spark, SF_DIR)
    assert loaded.count() == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    (kept,) = tmp_path.iterdir()
    assert kept.name.startswith("revenue-load")
    read = sum((Path(SF_DIR) / f"{t}.parquet").stat().st_size for t in ("lineitem", "orders"))
    landed = [f for part in ("archived", "current") for f in (kept / part).rglob("part-*")]
    assert len(landed) == 28 and sum(f.stat().st_size for f in landed) < 2 * read


def test_scratch_takes_only_what_was_written_inside(spark, frame):
    outside = session.materialized(frame("n int", (1,)), "outside")
    with pytest.raises(ValueError), session.scratch(spark):
        inside = session.materialized(frame("n int", (2,)), "inside")
        with session.scratch(spark):
            deeper = session.materialized(frame("n int", (3,)), "deeper")
        assert rows_of(inside) == [(2,)] and not Path(deeper.inputFiles()[0].removeprefix("file:")).exists()
        raise ValueError
    assert rows_of(outside) == [(1,)]
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_feed_round_trip(spark, frame):
    rows = frame("tile_id int, source_id int, type string, created_at timestamp, updated_at timestamp", (1, 2, 'a|"b"\nc', None, None))
    folder = shared_dir(spark, "feed")
    feeds.export_table(rows, "tile_source", folder)
    loaded = feeds.load_table(spark, "tile_source", folder, "2024-01-01 00:00:00")
    assert rows_of(loaded, "tile_id", "type", "created_at") == [("1", 'a|"b"\nc', None)]


def test_publisher_columns_are_required(frame):
    with pytest.raises(KeyError, match="log_total_saves"):
        finish_features(frame("top_domain_name string, total_save_count int, updated_at timestamp"))


# --- click spam and small expressions ------------------------------------------------------------
def test_click_spam_is_dropped_per_second(frame):
    schema = (
        "submission_timestamp timestamp, document_id string, impression_id string, loaded int, version string, "
        f"click int, block int, {fv.LEGACY_SAVE_COLUMN} int, page string, tiles array<struct<id:bigint,pos:int>>"
    )
    moment = datetime.datetime(2024, 1, 2, 3, 4, 5)
    pings = [(moment, f"d{i}", "c", None, "100.0", 1, None, None, None, [(1, 0)]) for i in range(3)]
    pings += [(moment, f"e{i}", "c", None, "100.0", 1, None, None, None, [(2, None)]) for i in range(2)]
    result = telemetry_legacy.engagement_by_tile_position_legacy(frame(schema, *pings), "2024-01-02 12:00:00")
    assert rows_of(result, "tile_id", "position", "click_count") == [(2, 0, 2)]


def test_a_look_back_over_two_months_gives_two_rows(frame):
    schema = (
        "submission_timestamp timestamp, document_id string, impression_id string, loaded int, version string, "
        f"click int, block int, {fv.LEGACY_SAVE_COLUMN} int, release_channel string, normalized_country_code string, "
        "locale string, user_prefs int, tiles array<struct<id:bigint,pos:int>>"
    )

    def ping(document, month, day, **changes):
        row = dict(loaded=None, version="100.0", click=None, block=None, save=None, channel="release", prefs=36) | changes
        return (datetime.datetime(2024, month, day), document, f"client-{document[0]}", row["loaded"], row["version"], row["click"],
                row["block"], row["save"], row["channel"], "US", "en-US", row["prefs"], [(1, None)])

    pings = frame(
        schema, ping("a1", 2, 3), ping("a2", 2, 20), ping("b1", 3, 2), ping("a3", 3, 2, click=1), ping("c1", 1, 31),
        ping("d1", 3, 3, loaded=1), ping("e1", 3, 3, version="121.0"), ping("f1", 3, 3, channel="beta"),
    )
    spocs = frame("tile_id bigint, type string", (1, "spoc"), (1, "spoc"))
    result = telemetry_legacy.monthly_unique_engagement_legacy(pings, spocs, "2024-03-03 00:00:00", "2024-03-04 00:00:00")
    assert [tuple(str(value) for value in row) for row in result.collect()] == [
        ("2024-02-01", "NEW_TAB_EN_US", "1", "0", "1", "1", "0", "2024-03-03"),
        ("2024-03-01", "NEW_TAB_EN_US", "1", "1", "1", "1", "1", "2024-03-03"),
    ]


def test_tiles_listed_twice_count_twice_but_not_in_the_day_total(frame):
    schema = (
        "submission_timestamp timestamp, document_id string, impression_id string, loaded int, version string, "
        f"click int, block int, {fv.LEGACY_SAVE_COLUMN} int, release_channel string, normalized_country_code string, "
        "locale string, user_prefs int, tiles array<struct<id:bigint,pos:int>>"
    )
    moment = datetime.datetime(2024, 1, 2)
    rows = [(moment, d, "c", None, "100.0", None, None, None, "release", country, locale, 36, [(9, 0), (1, 1)])
            for d, country, locale in (("x", "US", "en-US"), ("y", "DE", "de"))]
    spocs = frame("tile_id bigint, type string", (1, "spoc"), (1, "spoc"), (9, "other"), (9, "other"))
    bounds = ("2024-01-02 00:00:00", "2024-01-03 00:00:00")
    result = telemetry_legacy.daily_spoc_fill_rate_legacy(frame(schema, *rows), spocs, *bounds)
    counts = ("new_tab_impression_count", "position_total_impression_count", "position_spoc_impression_count")
    assert rows_of(result, "feed_name", "position", *counts) == [("NEW_TAB_DE_DE", 1, 2, 2, 2), ("NEW_TAB_EN_US", 1, 2, 2, 2)]


def test_exactly_one_identifier(frame):
    ids = frame("e string, a string", ("x", None), (None, "y"), ("x", "y"), (None, None))
    assert [r[0] for r in ids.select(exactly_one_id(F.col("e"), F.col("a"))).collect()] == [True, True, False, False]


def test_violations_name_their_sets(frame):
    items = frame("s string, id string, topic string, publisher string", ("a", "1", "t", "p"), ("b", "", "t", "p"), ("c", "1", None, "p"))
    sets = frame("s string, min_item_count int", ("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 0))
    assert [r[0] for r in rows_of(corpus_item_violations(items, sets, "s"), "s")] == ["b", "c", "d"]
    legacy = frame("s string, id bigint, publisher string", ("a", 1, "p"), ("b", 1, ""), ("c", None, "p"))
    assert [r[0] for r in rows_of(legacy_item_violations(legacy, sets, "s"), "s")] == ["b", "c", "d", "e"]
    with pytest.raises(ValueError, match="invalid"):
        require_none(corpus_item_violations(items, sets, "s"), "invalid sets")


def test_small_expressions(frame):
    df = frame("e string", ("a@b.c",), ("a@b",), ("",), (None,))
    assert [r[0] for r in df.select(expr.valid_email("e")).collect()] == [True, False, False, None]
    assert [r[0] for r in df.select(expr.mask_email("e")).collect()] == ["a@example.com", "a@example.com", None, None]
    assert [r[0] for r in df.select(expr.empty_to_null("e")).collect()] == ["a@b.c", "a@b", None, None]
    versions = frame("v string", ("121.0.1",), ("nightly",), ("x.1",), (None,))
    assert [r[0] for r in versions.select(expr.major_version("v")).collect()] == [121, None, None, None]
    flags = frame("b string", ("TRUE",), ("false",), ("yes",), ("1",), (None,))
    assert [r[0] for r in flags.select(expr.safe_boolean("b")).collect()] == [True, False, None, None, None]
    pairs = frame("country string, locale string", ("US", "en-GB"), ("BR", "pt-BR"), ("BE", "de-CH"), (None, "fr"))
    assert [r[0] for r in pairs.select(expr.feed_name("country", "locale")).collect()] == ["NEW_TAB_EN_US", None, "NEW_TAB_DE_DE", None]
    parts = frame("a string, b string", ("x", "y"), ("x", None))
    assert [r[0] for r in parts.select(expr.slash_key("a", "b")).collect()] == ["x/y", None]


def test_column_definitions():
    assert files.column_definitions("happened_at date not null,\n feed_name string, n number not null") == [
        ("happened_at", "date", True), ("feed_name", "string", False), ("n", "bigint", True),
    ]
