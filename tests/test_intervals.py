import pytest
from cases import plan_of, rows_of

from tideline.operators import intervals

FIRST = ("2023-06-17 21:59:59.999001", "2023-06-18 00:00:00")


def _plan(spark, *args, **kwargs):
    plan = intervals.interval_plan(spark, *args, **kwargs).orderBy("batch_start")
    texts = plan.selectExpr(
        *[f"CAST({c} AS STRING) AS {c}" for c in ("batch_start", "batch_end", "first_interval_start", "sets_end")],
        "is_initial",
        "is_final",
    )
    return [tuple(row) for row in texts.collect()]


def test_partial_first_piece_whole_days_and_partial_last(spark):
    rows = _plan(spark, "2023-06-17 21:59:59.999", end="2023-06-26 02:00:00")
    assert len(rows) == 10
    assert rows[0] == (*FIRST, "2023-06-18 00:00:00", "2023-06-26 02:00:00", True, False)
    assert rows[1][:2] == ("2023-06-18 00:00:00", "2023-06-19 00:00:00")
    assert rows[-1] == (
        "2023-06-26 00:00:00", "2023-06-26 02:00:00", "2023-06-18 00:00:00", "2023-06-26 02:00:00", False, True,
    )
    assert [r[1] for r in rows[:-1]] == [r[0] for r in rows[1:]]


@pytest.mark.parametrize("include_now", [True, False])
def test_end_at_midnight(spark, include_now):
    rows = _plan(spark, "2023-06-17 21:59:59.999", end="2023-06-26 00:00:00", include_now=include_now)
    assert len(rows) == 9
    assert {r[3] for r in rows} == {"2023-06-26 00:00:00"}
    assert rows[-1][4:] == (False, True)


def test_now_is_left_out_unless_asked_for(spark):
    now = "2023-06-20 10:11:12"
    rows = _plan(spark, "2023-06-17 10:11:12", now)
    assert len(rows) == 3 and rows[-1][1] == "2023-06-20 00:00:00"
    rows = _plan(spark, "2023-06-17 10:11:12", now, include_now=True)
    assert len(rows) == 4 and rows[-1][1] == now


def test_offset_just_before_midnight_starts_with_a_whole_day(spark):
    rows = _plan(spark, "2023-06-16 23:59:59.999999", "2023-06-20 10:00:00")
    assert len(rows) == 3
    assert rows[0][:3] == ("2023-06-17 00:00:00", "2023-06-18 00:00:00", "2023-06-17 00:00:00")


def test_offset_of_today(spark):
    assert _plan(spark, "2023-06-20 09:00:00", "2023-06-20 10:00:00") == []
    rows = _plan(spark, "2023-06-20 09:00:00", "2023-06-20 10:00:00", include_now=True)
    assert [r[:2] for r in rows] == [("2023-06-20 09:00:00.000001", "2023-06-20 10:00:00")]
    assert rows[0][4:] == (True, True)


def test_no_offset(spark):
    with pytest.raises(ValueError):
        intervals.interval_plan(spark, None, "2023-06-20 10:00:00")


def test_tag_batches_is_no_nested_loop(spark, frame):
    plan = intervals.interval_plan(spark, "2023-06-17 12:00:00", "2023-06-19 06:00:00", include_now=True)
    df = frame("id int, t string", (1, "2023-06-17 11:59:59"), (2, "2023-06-17 12:00:00"), (3, "2023-06-17 12:00:00.000001"),
               (4, "2023-06-18 00:00:00"), (5, "2023-06-19 05:59:59"), (6, "2023-06-19 06:00:00"))
    tagged = intervals.tag_batches(df.selectExpr("id", "CAST(t AS TIMESTAMP) AS t"), "t", plan)
    assert [r[0] for r in rows_of(tagged, "id")] == [3, 4, 5]
    assert "NestedLoop" not in plan_of(tagged) and "Cartesian" not in plan_of(tagged)


STAGED = [
    ("2023-06-17", t) for t in ("20-00-00-000", "21-59-59-999", "22-00-00-000")
] + [("2023-06-18", "00-00-00-000"), ("2023-06-18", "03-00-00-000"), ("2023-06-25", "00-00-00-000"),
     ("2023-06-30", "00-00-00-000")]


def test_stale_partitions(frame):
    paths = frame("path string", *[(f"gcs://stage/job/date={d}/time={t}/data_0.snappy.parquet",) for d, t in STAGED])
    found = intervals.stale_partitions(
        paths, "2023-06-17 21:59:59.999001", "2023-06-18 00:00:00", "2023-06-26 00:00:00"
    )
    assert rows_of(found) == [("date=2023-06-17/time=22-00-00-000",), ("date=2023-06-18",), ("date=2023-06-25",)]


def test_rolling_days_are_calendar_days(frame):
    df = frame("t string", ("2023-06-18 23:59:59",), ("2023-06-19 00:00:00",), ("2023-06-20 23:59:59",), ("2023-06-21 00:00:00",))
    kept = df.selectExpr("t", "CAST(t AS TIMESTAMP) AS ts").filter(intervals.rolling_days("ts", "2023-06-20 05:00:00"))
    assert rows_of(kept, "t") == [("2023-06-19 00:00:00",), ("2023-06-20 23:59:59",)]


def test_time_filters_reach_the_scan(spark, tmp_path):
    spark.range(3).selectExpr("id", "timestamp_seconds(id * 86400) AS ts").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for condition in (
        intervals.in_interval("ts", "1970-01-01 00:00:00", "1970-01-02 00:00:00"),
        intervals.rolling_days("ts", "1970-01-02 00:00:00"),
        intervals.month_lookback("ts", "1970-02-01 00:00:00", "1970-02-02 00:00:00"),
    ):
        pushed = plan_of(table.filter(condition)).split("PushedFilters: ")[1]
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_missing_days(frame, spark):
    held = frame("d string", ("2024-01-18",), ("2024-01-20",), ("2024-01-20",)).selectExpr("CAST(d AS DATE) AS d")
    found = intervals.missing_days(held, "d", "2024-01-31 08:00:00")
    days = [str(r["day"]) for r in found.collect()]
    assert days[0] == "2024-01-17" and days[-1] == "2024-01-30" and len(days) == 12
    everything = intervals.missing_days(held, "d", "2024-01-31 08:00:00", overwrite=True)
    assert everything.count() == 14
    full = spark.sql("SELECT explode(sequence(DATE'2024-01-17', DATE'2024-01-30')) AS d")
    assert intervals.missing_days(full, "d", "2024-01-31 08:00:00").isEmpty()
