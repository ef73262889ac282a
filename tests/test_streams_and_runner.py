from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from cases import rows_of
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tideline.functions.text import html_text_mapper
from tideline.operators import sketches
from tideline.plans.runner import Job, job_table, offset_log, run_incremental, stored_offset
from tideline.sample import catalog
from tideline.session import shared_dir
from tideline.sources.logs import OffsetLog
from tideline.streaming import streams


def _articles(spark, count):
    rows = spark.range(1, count + 1, 1, count).selectExpr("CAST(id AS STRING) AS resolved_id", "concat('<p>t', id, '</p>') AS article")
    folder = shared_dir(spark, "drop")
    rows.write.option("compression", "gzip").json(folder)
    return folder


@pytest.mark.parametrize("fails", [False, True])
def test_article_stream(spark, fails):
    def convert(html):
        if fails:
            raise ValueError("bad")
        return html[3:-4]

    drop, out, bad, checkpoint = _articles(spark, 7), *(shared_dir(spark, n) for n in ("out", "bad", "cp"))
    query = streams.article_stream(
        spark, drop, out, bad, checkpoint, "run", "2024-01-01 00:00:00", convert, files_per_trigger=3
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    assert rows.select("batch").distinct().count() == 3
    assert rows.count() == 7
    texts = [r[0] for r in rows_of(rows, "text")]
    assert texts == ([None] * 7 if fails else [f"t{i}" for i in range(1, 8)])
    if fails:
        assert spark.read.json(bad).count() == 7
    again = streams.article_stream(spark, drop, out, bad, checkpoint, "run", "2024-01-01 00:00:00", convert)
    again.awaitTermination()
    assert spark.read.parquet(f"{out}/rows").count() == 7


def _stream(spark, rows, schema):
    folder = shared_dir(spark, "events")
    spark.createDataFrame(rows, schema).selectExpr("* EXCEPT (t)", "CAST(t AS TIMESTAMP) AS t").coalesce(1).write.parquet(folder)
    read = spark.read.parquet(folder)
    return streams.file_stream(spark, folder, read.schema), read


def _finish(spark, stream):
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "cp")
    streams.write_batches(stream, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def test_second_click_stream(spark):
    rows = [("2024-01-01 00:00:01", "a", 1)] * 3 + [("2024-01-01 00:00:02", "a", 1)] * 2 + [("2024-01-01 00:10:00", "b", 0)]
    stream, _ = _stream(spark, rows, "t string, user string, click int")
    counted = streams.second_click_stream(stream, "t", ["user"], F.col("click") == 1, late="1 second")
    assert rows_of(_finish(spark, counted), "user", "rows", "clicks") == [("a", 2, 2)]


def test_deduplicated_stream(spark):
    rows = [("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:02", "a"), ("2024-01-01 00:00:02", "b")]
    stream, _ = _stream(spark, rows, "t string, k string")
    unique = streams.deduplicated_stream(stream, "t", ["k"])
    assert [r[0] for r in rows_of(_finish(spark, unique), "k")] == ["a", "b"]


def test_trailing_stream_matches_a_batch_window(spark):
    rows = [(f"2024-01-01 {h:02d}:00:00", "r", "impression" if h % 3 else "click", f"d{h % 7}") for h in range(24)]
    rows.append(("2024-01-09 00:00:00", "z", "click", "d"))
    stream, batch = _stream(spark, rows, "t string, k string, n string, d string")
    panes = _finish(spark, streams.engagement_pane_stream(stream, "t", "k", "n", "d"))
    windows = streams.trailing_engagement(panes, "k", slide=6 * 3600)
    expected = (
        batch.filter("k = 'r'").groupBy(F.window("t", "1 day", "6 hours"))
        .agg(F.count_distinct(F.when(F.col("n") == "impression", F.col("d"))).alias("i"),
             F.count_distinct(F.when(F.col("n") == "click", F.col("d"))).alias("o"))
    )
    found = rows_of(windows.filter("k = 'r'"), "window_start", "trailing_1_day_impressions", "trailing_1_day_opens")
    assert found == rows_of(expected.selectExpr("window.start AS window_start", "i", "o"))


def test_trailing_query_has_every_window(spark):
    """Also the windows that reach past the last event, against a batch window over the whole table."""
    folder = "/root/testdata/sf0.001"
    found = queries()["stream_trailing_engagement"](spark, folder)
    day = F.window(F.col("ts").cast("timestamp"), "1 day", "6 hours")
    events = spark.read.parquet(f"{folder}/events.parquet")
    wanted = events.groupBy(day.alias("w"), "event_type").agg(F.max(F.col("ts").cast("timestamp")).alias("u"))
    assert rows_of(found, "window_start", "window_end", "kind", "updated_at") == rows_of(
        wanted.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c[-1]) for c in ("w.start", "w.end", "u")], "event_type"),
        "t", "d", "event_type", "u",
    )


def test_newest_rows_over_batches(spark):
    """A window changed by several micro-batches stands once, with the counts of them all."""
    schema = "t timestamp, k string, n string, d string"
    folder, out = shared_dir(spark, "several"), shared_dir(spark, "several-out")
    for i, rows in enumerate([[("10:00", "a")], [("11:00", "b"), ("11:30", "a")], [("12:00", "c")]]):
        batch = spark.createDataFrame([(f"2024-01-01 {t}:00", "r", "click", d) for t, d in rows], "t string, k string, n string, d string")
        batch.selectExpr("CAST(t AS TIMESTAMP) AS t", "k", "n", "d").coalesce(1).write.mode("append").parquet(folder)
    stream = streams.file_stream(spark, folder, schema, files_per_trigger=1)
    panes = streams.engagement_pane_stream(stream, "t", "k", "n", "d", pane="1 day", late="1 day")
    streams.write_batches(panes, out, shared_dir(spark, "several-checkpoint"), mode="update").awaitTermination()
    assert spark.read.parquet(out).count() == 3
    newest = streams.trailing_engagement(streams.newest_rows(spark, out, ["pane", "k"]), "k", slide=86400)
    assert rows_of(newest, "k", "trailing_1_day_impressions", "trailing_1_day_opens") == [("r", 0, 3)]


def test_sliding_windows_copy_no_sketch_and_agree_with_the_batch(spark):
    """A quarter of an hour as slide: 96 windows a pane; the same panes by stream and batch give the same windows."""
    rows = [(f"2024-01-0{1 + h % 3} {h % 24:02d}:{h % 60:02d}:00", "ab"[h % 2], "click", f"d{h % 50}") for h in range(300)]
    stream, batch = _stream(spark, rows, "t string, k string, n string, d string")
    out = shared_dir(spark, "panes")
    panes = streams.engagement_pane_stream(stream, "t", "k", "n", "d", late="9 days")
    streams.write_batches(panes, out, shared_dir(spark, "panes-checkpoint"), mode="update").awaitTermination()
    found = streams.trailing_engagement(streams.newest_rows(spark, out, ["pane", "k"]), "k")
    counted = {"trailing_1_day_impressions": F.when(F.col("n") == "impression", F.col("d")), "trailing_1_day_opens": F.col("d")}
    held = sketches.pane_sketches(batch, "t", ["k"], counted)
    wanted = batch.groupBy(F.window("t", "1 day", "15 minutes").alias("w"), "k").agg(F.count_distinct("d").alias("o"), F.max("t").alias("u"))
    rows = rows_of(found, "window_start", "window_end", "k", "trailing_1_day_opens", "updated_at")
    assert rows == rows_of(wanted.select("w.start", "w.end", "k", "o", "u"))
    assert rows == rows_of(sketches.trailing_windows(held, ["k"], list(counted), 86400, 900), "window_start", "window_end", "k", "trailing_1_day_opens", "updated_at")
    with pytest.raises(ValueError, match="multiple"):
        sketches.trailing_windows(held, ["k"], list(counted), 1000, 900)


def test_estimates_stay_within_three_errors(spark):
    many = spark.range(200_000).selectExpr("CAST('2024-01-01' AS TIMESTAMP) + make_interval(0,0,0,0,0,0,id % 80000) AS t", "id % 3 AS k", "id % 60000 AS d")
    panes = sketches.pane_sketches(many, "t", ["k"], {"n": F.col("d")})
    exact = many.groupBy("k").agg(F.count_distinct("d").alias("exact"))
    both = sketches.united(panes, ["k"], ["n"]).join(exact, "k")
    assert both.filter(sketches.within_error(F.col("n"), F.col("exact"))).count() == 3
    assert both.filter(sketches.within_error(F.col("n") * 1.06, F.col("exact"))).count() == 0


@pytest.mark.parametrize("mode", ["append", "update"])
def test_latest_stream_over_restarts(spark, mode):
    """Late, repeated and tied rows over two runs; append mode gives the days that the watermark has closed."""
    schema = "t timestamp, k string, v int"
    drop, out, checkpoint = (shared_dir(spark, n) for n in ("latest-drop", "latest", "latest-checkpoint"))
    files = [
        [("2024-01-01 10:00:00", "a", 1), ("2024-01-01 09:00:00", "a", 2), ("2024-01-02 01:00:00", None, 3)],
        [("2024-01-01 10:00:00", "a", 4), ("2024-01-01 10:00:00", "a", 1), ("2024-01-01 08:00:00", "b", 5)],
        [("2024-01-05 00:00:00", "z", 6)], [("2024-01-09 00:00:00", "z", 7)],
    ]
    for at, rows in enumerate(files):
        frame = spark.createDataFrame(rows, "t string, k string, v int").selectExpr("CAST(t AS TIMESTAMP) AS t", "k", "v")
        frame.coalesce(1).write.mode("append").parquet(drop)
        if at % 2:
            arriving = streams.file_stream(spark, drop, schema, files_per_trigger=1)
            latest = streams.latest_stream(arriving, "t", ["k"], ["v"], late="2 days")
            streams.write_batches(latest, out, checkpoint, mode=mode).awaitTermination()
    rows = streams.newest_rows(spark, out, ["period_start", "k"])
    closed = [("a", 4), ("b", 5), (None, 3), ("z", 6)]
    assert rows_of(rows, "k", "v") == sorted(closed if mode == "append" else [*closed, ("z", 7)], key=repr)


def test_update_mode_keeps_no_second_that_turns_out_spam(spark):
    folder, out = shared_dir(spark, "spam"), shared_dir(spark, "spam-out")
    for _ in range(2):
        rows = spark.createDataFrame([("2024-01-01 00:00:01", "a")] * 2 + [("2024-01-01 00:00:01", "b")], "t string, user string")
        rows.selectExpr("CAST(t AS TIMESTAMP) AS t", "user").coalesce(1).write.mode("append").parquet(folder)
    stream = streams.file_stream(spark, folder, "t timestamp, user string", files_per_trigger=1)
    counts = streams.second_count_stream(stream, "t", ["user"], F.lit(True))
    streams.write_batches(counts, out, shared_dir(spark, "spam-checkpoint"), mode="update").awaitTermination()
    newest = streams.newest_rows(spark, out, ["second", "user"])
    assert rows_of(newest, "user", "clicks") == [("a", 4), ("b", 2)]
    assert rows_of(streams.without_click_spam(newest), "user", "clicks") == [("b", 2)]


# --- incremental runs ------------------------------------------------------------------------
def _job(spark, events, **kwargs):
    def extract(start, end):
        rows = events.filter(F.col("t") >= F.lit(start))
        rows = rows.filter(F.col("t") < F.lit(end)) if end is not None else rows
        return rows.groupBy(F.to_date("t").alias("day")).agg(F.count("*").alias("n"))

    def offset(start, end):
        return events.filter((F.col("t") >= F.lit(start)) & (F.col("t") < F.lit(end))).agg(F.max("t")).first()[0]

    return Job("daily", extract, offset, columns=[("day", "date"), ("n", "bigint")], required=["day", "n"], merge_key="day", **kwargs)


@pytest.fixture
def events(spark):
    days = ["2024-01-01 10:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00", "2024-01-04 08:00:00", "2024-01-05 01:00:00"]
    return spark.createDataFrame([(d,) for d in days], "t string").selectExpr("CAST(t AS TIMESTAMP) AS t")


def test_incremental_run(spark, events):
    root = shared_dir(spark, "run")
    job = _job(spark, events, initial_offset="2023-12-31 23:59:59.999999")
    outcomes = run_incremental(spark, job, root, "2024-01-05 06:00:00")
    assert [o for _, o in outcomes] == ["loaded", "loaded", "no rows", "loaded"]
    table = job_table(spark, root, job)
    assert [n for _, n in rows_of(table.read().selectExpr("CAST(day AS STRING)", "n"))] == [2, 1, 1]
    assert stored_offset(spark, root, "daily").startswith("2024-01-04 08:00:00")
    lineage = table.read().select("_gs_file_date", "_gs_file_time").distinct()
    assert ("date=2024-01-04", "time=00-00-00-000") in rows_of(lineage)
    # the next run starts behind the stored offset and reaches up to now
    later = _job(spark, events, include_now=True)
    run_incremental(spark, later, root, "2024-01-05 06:00:00")
    assert rows_of(table.read().selectExpr("CAST(day AS STRING)", "n"))[-1] == ("2024-01-05", 1)


def test_backfill_replaces(spark, events):
    root = shared_dir(spark, "backfill")
    job = _job(spark, events, initial_offset="2023-12-31 23:59:59.999999")
    run_incremental(spark, job, root, "2024-01-05 06:00:00")
    again = _job(spark, events, override_offset="2024-01-01 23:59:59.999999", override_end="2024-01-05 00:00:00")
    run_incremental(spark, again, root, "2024-01-05 06:00:00")
    table = job_table(spark, root, job)
    assert rows_of(table.read().selectExpr("CAST(day AS STRING)", "n")) == [("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-04", 1)]


def test_catching_up_writes_each_day_once(spark, events):
    root = shared_dir(spark, "files")
    job = _job(spark, events, initial_offset="2023-12-31 23:59:59.999999")
    run_incremental(spark, job, root, "2024-01-05 06:00:00")
    table = job_table(spark, root, job)
    before = {r["day"]: r["f"] for r in table.read().select("day", F.input_file_name().alias("f")).collect()}
    assert [row["days"] for row in table.loads()] == [["2024-01-01"], ["2024-01-02"], ["2024-01-04"]]
    again = _job(spark, events, override_offset="2024-01-03 23:59:59.999999", override_end="2024-01-05 00:00:00")
    run_incremental(spark, again, root, "2024-01-06 06:00:00")
    after = {r["day"]: r["f"] for r in table.read().select("day", F.input_file_name().alias("f")).collect()}
    assert {str(d) for d in before if before[d] == after[d]} == {"2024-01-01", "2024-01-02"} and len(after) == 3


def test_interval_that_dies_before_its_offset_comes_again(spark, events, monkeypatch):
    root = shared_dir(spark, "killed")
    job = _job(spark, events, initial_offset="2023-12-31 23:59:59.999999")
    record, calls = OffsetLog.record, []

    def dying(self, *arguments):
        calls.append(arguments)
        if len(calls) == 2:
            raise RuntimeError("killed")
        record(self, *arguments)

    monkeypatch.setattr(OffsetLog, "record", dying)
    with pytest.raises(RuntimeError, match="killed"):
        run_incremental(spark, job, root, "2024-01-05 06:00:00")
    assert stored_offset(spark, root, "daily").startswith("2024-01-01 12")
    run_incremental(spark, job, root, "2024-01-05 06:00:00")
    rows = job_table(spark, root, job).read().selectExpr("CAST(day AS STRING)", "n")
    assert rows_of(rows) == [("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-04", 1)]
    assert stored_offset(spark, root, "daily").startswith("2024-01-04 08")


def test_two_writers_of_the_offset_log_lose_nothing(spark):
    path = shared_dir(spark, "two-writers")
    logs = [OffsetLog(spark, path) for _ in range(2)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: logs[k % 2].record(f"job{k}", "b", k, "2024-01-01 00:00:00"), range(6)))
    assert rows_of(logs[0].state(), "sql_folder_name", "last_offset") == [(f"job{k}", str(k)) for k in range(6)]
    logs[0].record("job1", "b", 7, "2024-01-02 00:00:00")
    logs[1].record("job1", "c", 8, "2024-01-03 00:00:00")
    logs[1].record("job1", "c", 8, "2024-01-03 00:00:00")
    assert logs[0].last("job1") == "8" and logs[0].last("none", "x") == "x"
    state = logs[0].state().filter("sql_folder_name = 'job1'").selectExpr("CAST(created_at AS STRING)", "CAST(updated_at AS STRING)")
    assert rows_of(state) == [("2024-01-02 00:00:00", "2024-01-03 00:00:00")]


def test_batches_already_logged_are_skipped(spark):
    log, written = OffsetLog(spark, shared_dir(spark, "batches")), []

    def sink(batch, batch_id):
        written.append((batch_id, batch.count()))
        if len(written) == 2:
            raise RuntimeError("killed")
        return batch.agg(F.max("id")).first()[0]

    guarded = log.once("stream", sink, "2024-01-01 00:00:00")
    guarded(spark.range(3), 0)
    with pytest.raises(RuntimeError):
        guarded(spark.range(5), 1)
    for batch_id in (0, 1, 1):
        guarded(spark.range(5), batch_id)
    assert written == [(0, 3), (1, 5), (1, 5)] and log.last("stream") == "4"


def test_job_without_offset(spark, events):
    root = shared_dir(spark, "single")
    job = _job(spark, events, incremental=False)
    outcomes = run_incremental(spark, job, root, "2024-01-02 00:00:00")
    assert len(outcomes) == 1
    assert job_table(spark, root, job).read().count() == 3
    with pytest.raises(ValueError, match="offset"):
        run_incremental(spark, _job(spark, events), shared_dir(spark, "none"), "2024-01-02 00:00:00")


def test_failing_sub_job_ends_the_run(spark, events):
    def broken(start, end):
        raise RuntimeError("broken")

    job = _job(spark, events, initial_offset="2024-01-03 23:59:59.999999")
    job.sub_jobs = [Job("sub", broken, incremental=False)]
    with pytest.raises(RuntimeError, match="broken"):
        run_incremental(spark, job, shared_dir(spark, "broken"), "2024-01-05 06:00:00")


def test_sub_jobs_share_the_offset_table(spark, events):
    root = shared_dir(spark, "subs")
    job = Job("parent", lambda start, end: events.limit(0), incremental=False)
    job.sub_jobs = [_job(spark, events, initial_offset="2024-01-03 23:59:59.999999") for _ in range(3)]
    for i, sub in enumerate(job.sub_jobs):
        sub.name = f"sub{i}"
    outcomes = run_incremental(spark, job, root, "2024-01-05 06:00:00")
    assert [o for _, o in outcomes] == ["loaded"] * 4
    assert all(stored_offset(spark, root, f"sub{i}").startswith("2024-01-04 08") for i in range(3))


def test_the_html_parser_holds_few_rows_at_a_time():
    batch = pa.RecordBatch.from_pydict({"resolved_id": [str(i) for i in range(250)], "html": [None, "<p>a  b</p>"] * 125})
    pieces = list(html_text_mapper()(iter([batch])))
    assert [piece.num_rows for piece in pieces] == [100, 100, 50]
    rows = [row for piece in pieces for row in piece.to_pylist()]
    assert [row["resolved_id"] for row in rows] == [str(i) for i in range(250)]
    assert [row["raw_text"].strip() for row in rows[:2]] == ["None", "a b"] and all(row["error"] is None for row in rows)


def test_landed_files_follow_the_rows_not_the_splits(spark, monkeypatch):
    folders = {}
    monkeypatch.setattr(catalog, "shared_dir", lambda s, name: folders.setdefault(name, shared_dir(s, name)))
    monkeypatch.setattr(catalog, "_ROWS_PER_LANDED_FILE", 200)
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").limit(900)
    small = shared_dir(spark, "few-events")
    events.write.parquet(f"{small}/events.parquet")
    rows = queries()["stream_latest"](spark, small).select("event_id").collect()
    newest = events.groupBy(F.to_date("ts"), "user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert sorted(r[0] for r in rows) == sorted(r["event_id"] for r in newest.collect())
    assert len(spark.read.parquet(folders["latest-drop"]).inputFiles()) == 6


def test_archived_sources_of_several_files(spark, monkeypatch):
    folders = {}
    monkeypatch.setattr(catalog, "shared_dir", lambda s, name: folders.setdefault(name, shared_dir(s, name)))
    monkeypatch.setattr(catalog, "_ROWS_PER_LANDED_FILE", 10)
    small = shared_dir(spark, "few-pages")
    spark.range(100).selectExpr("id AS page_id", "concat('<p>', id) AS html").write.parquet(f"{small}/pages.parquet")
    found = queries()["stream_archived_sources"](spark, small)
    wanted = [(i, "drop" if i % 4 == 3 else "archive") for i in range(100)] + [(i, "read") for i in range(100)]
    assert rows_of(found, "page_id", "place") == sorted(wanted, key=repr)
    assert len(spark.read.parquet(folders["sources"]).inputFiles()) == 3
