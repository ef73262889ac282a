import time

import pytest
from cases import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.functions.expr import parse_iso8601
from tideline.operators import chunks, latest, tables
from tideline.session import SHUFFLE_CLEANUP, configure, materialized, shared_dir
from tideline.sources import tables as table_io


def test_range_replace(frame):
    target = frame("k int, v string", (1, "a"), (2, "a"), (3, "a"), (None, "a"))
    batch = frame("k int, v string", (2, "b"), (5, "b"))
    replaced = tables.range_replace(target, batch, "k")
    assert rows_of(replaced) == [(1, "a"), (2, "b"), (5, "b"), (None, "a")]
    assert rows_of(tables.range_replace(replaced, batch, "k")) == rows_of(replaced)
    assert rows_of(tables.range_replace(target, batch.limit(0), "k")) == rows_of(target)


def test_range_replace_refuses_nulls(frame):
    target = frame("k int, v string", (1, "a"))
    with pytest.raises(Exception, match="required column v"):
        tables.range_replace(target, frame("k int, v string", (2, None)), "k", ["v"]).collect()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 6), st.sampled_from("ab")), max_size=12),
    st.lists(st.tuples(st.integers(0, 6), st.sampled_from("xy")), max_size=6),
)
def test_key_replace(frame, old, new):
    target, batch = frame("k int, v string", *old), frame("k int, v string", *new)
    keys = {k for k, _ in new}
    expected = sorted([row for row in old if row[0] not in keys] + new, key=repr)
    replaced = tables.key_replace(target, batch, "k")
    assert rows_of(replaced) == expected
    assert rows_of(tables.key_replace(replaced, batch, "k")) == expected


def test_key_replace_refuses_many_keys(frame, monkeypatch):
    monkeypatch.setattr(tables, "MAX_KEYS", 2)
    target = frame("k int, v string", (1, "a"), (4, "a"))
    two = frame("k int, v string", (1, "b"), (2, "b"), (2, "c"))
    assert rows_of(tables.key_replace(target, two, "k")) == [(1, "b"), (2, "b"), (2, "c"), (4, "a")]
    with pytest.raises(Exception, match="more than 2 values of k"):
        tables.key_replace(target, frame("k int, v string", (1, "b"), (2, "b"), (3, "b")), "k").collect()


def test_upsert_keeps_creation_and_other_columns(frame):
    target = frame("k int, created string, v string, note string", (1, "t0", "a", "n1"), (2, "t0", "a", "n2"), (None, "t0", "a", "n"))
    batch = frame("k int, created string, v string", (2, "t1", "b"), (3, "t1", "b"), (None, "t1", "b"))
    merged = tables.upsert(target, batch, ["k"], ["v"], ["created"])
    assert rows_of(merged) == sorted(
        [(1, "t0", "a", "n1"), (2, "t0", "b", "n2"), (3, "t1", "b", None), (None, "t0", "a", "n"), (None, "t1", "b", None)],
        key=repr,
    )


def test_offsets(frame):
    state = frame("sql_folder_name string, created_at timestamp, updated_at timestamp, last_offset string")
    assert tables.last_offset(state, "job", "2024-01-01").first()[0] == "2024-01-01"
    state = tables.upsert_offset(state, "job", "2024-01-02", "2024-01-02 10:00:00")
    state = tables.upsert_offset(state, "job", "2024-01-03", "2024-01-03 10:00:00")
    row = state.selectExpr("CAST(created_at AS STRING) c", "CAST(updated_at AS STRING) u", "last_offset").collect()
    assert [tuple(r) for r in row] == [("2024-01-02 10:00:00", "2024-01-03 10:00:00", "2024-01-03")]


def test_purge_keeps_null_keys_and_avoids_nested_loops(frame):
    target = frame("a int, b string, n int", (1, "x", 1), (2, "y", 2), (None, "x", 3), (None, None, 4), (5, "z", 5))
    keys = frame("a int, b string", (1, None), (None, "z"), (None, None), (1, "q"))
    purged = tables.purge(target, keys, [("a", "a"), ("b", "b")])
    assert rows_of(purged, "n") == [(2,), (3,), (4,)]
    assert "NestedLoop" not in plan_of(purged) and "Cartesian" not in plan_of(purged)
    only = tables.purge(target, keys, [("a", "a")], only_if=F.col("b") == "y")
    assert only.count() == 5


def test_new_keys(frame):
    source = frame("h string, u int", ("a", 1), ("a", 1), ("b", 2), (None, 3))
    known = frame("h string, u int", ("b", 2), (None, 3))
    assert rows_of(tables.new_keys(source, known, ["h", "u"])) == [("a", 1), (None, 3)]
    assert rows_of(tables.new_keys(source, known, ["h", "u"], null_safe=True)) == [("a", 1)]


def test_newer_than_target(frame):
    rows = frame("t string", ("2024-01-01 00:00:00",), ("2024-01-03 00:00:00",)).selectExpr("CAST(t AS TIMESTAMP) AS t")
    assert tables.newer_than_target(rows, rows.limit(0), "t", "2024-01-02 00:00:00").count() == 1
    assert tables.newer_than_target(rows, rows, "t", "2023-01-01 00:00:00").count() == 0


def test_compaction(frame):
    rows = frame("id int, t int, v string", (1, 1, "a"), (1, 2, "b"), (2, 1, "c"))
    compact = tables.compact_latest(rows, "id", "t", "2024-01-01 00:00:00")
    assert rows_of(compact, "id", "v") == [(1, "b"), (2, "c")]
    again = tables.compact_latest(compact.drop("last_ordered"), "id", "t", "2024-01-01 00:00:00")
    assert rows_of(again) == rows_of(compact)


def test_latest_limits_groups_before_the_shuffle(frame):
    rows = frame("k int, t int, tie int", (1, 5, 1), (1, 5, 2), (1, 4, 9), (2, None, 1), (2, 1, 1))
    newest = latest.latest_per_key(rows, "k", "t", "tie")
    assert rows_of(newest) == [(1, 5, 2), (2, 1, 1)]
    assert rows_of(latest.latest_per_key(rows, "k", "t", "tie", nulls_first=True)) == [(1, 5, 2), (2, None, 1)]
    assert rows_of(latest.latest_per_key(rows, "k", "t", "tie", ascending=True)) == [(1, 4, 9), (2, 1, 1)]
    plan = plan_of(latest.latest_per_key(rows.filter("k > 0").repartition(2), "k", "t", "tie"))
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.rindex("hashpartitioning") < partial


def test_large_groups_keep_their_order(spark):
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 100) END AS g")
    chunked = chunks.chunk_rows(rows.repartition(5), 7, ["g"], [F.desc("id")], ["id"])
    numbered = {(row["g"], row["row_no"]): (row["id"], row["chunk_no"]) for row in chunked.collect()}
    groups = {}
    for row in rows.orderBy(F.desc("id")).collect():
        groups.setdefault(row["g"], []).append(row["id"])
    assert numbered == {(g, k + 1): (i, k // 7) for g, ids in groups.items() for k, i in enumerate(ids)}
    collected = chunks.collect_chunks(chunked, ["g"], {"ids": F.col("id")}).collect()
    assert {(r["g"], r["chunk_no"]): r["ids"] for r in collected} == {
        (g, k // 7): ids[k : k + 7] for g, ids in groups.items() for k in range(0, len(ids), 7)
    }


def test_groups_of_a_million_rows_are_one_list(spark):
    rows = spark.range(1_200_000).selectExpr("id", "IF(id % 4 = 0, NULL, 'hot') AS g")
    chunked = chunks.chunk_rows(rows, chunks.ONE_LIST, ["g"], [F.asc("id")], ["id"])
    wrong = chunked.filter("chunk_no <> 0 OR row_no <> IF(g IS NULL, id DIV 4 + 1, id - id DIV 4)")
    assert chunked.count() == 1_200_000 and wrong.count() == 0


def test_tables_with_map_columns(frame):
    target = frame("k string, m map<string,int>", ("a", {"x": 1}), ("b", {"y": 2}), (None, {"z": 3}))
    batch = frame("k string, m map<string,int>", ("b", {"y": 9}), ("c", {}), (None, {"n": 1}))
    changed = tables.upsert(target, batch, ["k"], ["m"])
    expected = [("a", {"x": 1}), ("b", {"y": 9}), ("c", {}), (None, {"n": 1}), (None, {"z": 3})]
    assert sorted(((r["k"], r["m"]) for r in changed.collect()), key=str) == sorted(expected, key=str)
    kept = tables.purge(target, frame("k string", ("a",), (None,)), [("k", "k")])
    assert {r["k"] for r in kept.collect()} == {"b", None}


def test_a_key_twice_in_the_batch_fails(frame):
    target, batch = frame("k int, v int", (1, 1)), frame("k int, v int", (2, 1), (2, 2))
    with pytest.raises(Exception, match="key held twice"):
        tables.upsert(target, batch, ["k"], ["v"]).collect()


def test_times_that_are_none_fail(frame):
    rows = frame("t string", ("2024-01-02T03:04:05.250Z",), ("2024-01-02T03:04:05+01:00",), (None,))
    assert rows.select(parse_iso8601("t").cast("string")).toPandas().iloc[:, 0].dropna().tolist() == [
        "2024-01-02 03:04:05.25", "2024-01-02 02:04:05",
    ]
    for wrong in ("2024", "2024-13-02T00:00:00Z", "soon"):
        with pytest.raises(Exception, match="not an ISO-8601 time"):
            frame("t string", (wrong,)).select(parse_iso8601("t")).collect()


def _day_rows(frame, *rows):
    return frame("day string, v int", *rows).selectExpr("CAST(day AS DATE) AS day", "v")


def test_day_table(spark, frame):
    table = table_io.DayTable(spark, shared_dir(spark, "day-table"), "day")
    with pytest.raises(FileNotFoundError):
        table.read()
    first = _day_rows(frame, ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), (None, 9))
    table.replace(first)
    files = {r["v"]: r["f"] for r in table.read().select("v", F.input_file_name().alias("f")).collect()}
    table.replace(_day_rows(frame, ("2024-01-02", 20)))
    assert rows_of(table.read(), "v") == [(1,), (20,), (3,), (9,)]
    table.replace(_day_rows(frame, ("2024-01-02", 21), ("2024-01-05", 5)), "from")
    assert rows_of(table.read(), "v") == [(1,), (21,), (5,), (9,)]
    table.replace(first.limit(0), "from")
    table.replace(first.limit(0))
    assert rows_of(table.read(), "v") == [(1,), (21,), (5,), (9,)]
    now = {r["v"]: r["f"] for r in table.read().select("v", F.input_file_name().alias("f")).collect()}
    assert now[1] == files[1] and now[9] == files[9]
    assert table.vacuum() == 3 and rows_of(table.read(), "v") == [(1,), (21,), (5,), (9,)]
    table.replace(table.read().filter("v = 5"), "all")
    assert rows_of(table.read(), "v") == [(5,)]
    table.replace(first.limit(0), "all")
    assert table.read().columns == ["day", "v"] and table.read().count() == 0


def test_load_with_forbidden_rows_does_not_count(spark, frame):
    table = table_io.DayTable(spark, shared_dir(spark, "checked"), "day")
    wrong = {"negative v": F.col("v") < 0, "no day": F.col("day").isNull()}
    table.replace(_day_rows(frame, ("2024-01-01", 1)), "days", wrong)
    with pytest.raises(ValueError, match="of 4: {'negative v': 2, 'no day': 1}"):
        table.replace(_day_rows(frame, ("2024-01-01", -1), ("2024-01-02", -2), (None, 5), ("2024-01-03", None)), "days", wrong)
    assert rows_of(table.read(), "v") == [(1,)] and len(table.loads()) == 1
    table.replace(_day_rows(frame, ("2024-01-01", 1)).limit(0), "days", wrong)
    assert rows_of(table.read(), "v") == [(1,)]


def test_a_load_that_is_not_accepted_does_not_count(spark, frame):
    table, seen = table_io.DayTable(spark, shared_dir(spark, "accepted"), "day"), []

    def accept(days):
        seen.append(days)
        if "2024-01-02" not in days:
            raise ValueError("a day is missing")

    table.replace(_day_rows(frame, ("2024-01-01", 1), ("2024-01-02", 2), (None, 3)), "days", accept=accept)
    with pytest.raises(ValueError, match="a day is missing"):
        table.replace(_day_rows(frame, ("2024-01-01", 9)), "days", accept=accept)
    assert seen == [["2024-01-01", "2024-01-02"], ["2024-01-01"]]
    assert sorted(r["v"] for r in table.read().collect()) == [1, 2, 3] and len(table.loads()) == 1


def test_load_that_dies_is_ignored(spark, frame, monkeypatch):
    folder = shared_dir(spark, "unfinished")
    table = table_io.DayTable(spark, folder, "day")
    table.replace(_day_rows(frame, ("2024-01-01", 1)))

    def dying(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="killed"):
        patched.setattr(table.log, "add", dying)
        table.replace(_day_rows(frame, ("2024-01-01", 8), ("2024-01-02", 9)))
    assert rows_of(table.read(), "v") == [(1,)]
    table.replace(_day_rows(frame, ("2024-01-01", 3)))
    assert rows_of(table_io.DayTable(spark, folder, "day").read(), "v") == [(3,)]
    assert table.vacuum() == 3


def test_replace_days_twice_is_the_same(spark, frame):
    folder = shared_dir(spark, "days")
    old = frame("day string, v int", ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3))
    old.write.partitionBy("day").parquet(folder)
    batch = frame("day string, v int", ("2024-01-02", 20))
    for _ in range(2):
        table_io.replace_days(spark, batch, folder, "day", open_ended=True)
        found = spark.read.schema("v int, day string").parquet(folder)
        assert rows_of(found, "day", "v") == [("2024-01-01", 1), ("2024-01-02", 20)]
    table_io.replace_days(spark, batch.limit(0), folder, "day", open_ended=True)
    assert spark.read.parquet(folder).count() == 2


def test_shuffle_partitions_follow_the_input(spark):
    before = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )}
    try:
        configure(spark, input_bytes=10 * 1024**4)
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == str(10 * 8192)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_merged_shuffle_partitions_stay_small(spark):
    """Groupings give a task no more than some 8 MB of shuffled rows, few tasks or not."""
    changed = ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionNum", "coalescePartitions.initialPartitionNum")
    before = {k: spark.conf.get(k, None) for k in (f"spark.sql.adaptive.{name}" for name in changed)}
    least, start = list(before)[1:]
    try:
        spark.conf.unset(list(before)[0])
        configure(spark)
        spark.conf.set(least, "1")
        spark.conf.set(start, "64")
        rows = spark.range(3_000_000).selectExpr("xxhash64(id) AS k", "xxhash64(id, 1) AS v")
        tasks = rows.groupBy("k").agg(F.sum("v").alias("v")).rdd.getNumPartitions()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert tasks >= 5


def test_written_steps_leave_no_shuffle_files(spark):
    """Whatever the driver's garbage collector does; else the files of all steps of a job add up."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles().mkString("\n").split("\n")
        return {f for f in files if f.rsplit("/", 1)[-1].startswith("shuffle_")}

    kept = spark.conf.get(SHUFFLE_CLEANUP, None)
    plain = spark.range(100_000).selectExpr("id % 1000 AS k").groupBy("k").count()
    plain.write.format("noop").mode("overwrite").save()
    before = shuffled()
    assert before
    written = materialized(spark.range(100_000).selectExpr("id % 1000 AS k", "id").groupBy("k").agg(F.sum("id").alias("n")), "steps")
    left, until = shuffled() - before, time.monotonic() + 20
    while left and time.monotonic() < until:
        time.sleep(0.1)
        left = shuffled() - before
    assert not left and written.count() == 1000
    with pytest.raises(Exception, match="wrong"):
        materialized(spark.range(1).select(F.raise_error(F.lit("wrong")).alias("x")), "steps")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == kept
