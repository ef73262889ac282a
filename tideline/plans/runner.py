"""Runs an incremental job: offset, intervals, staged export, load, new offset."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import as_timestamp
from ..operators.intervals import folder_names, interval_plan, stale_partitions
from ..sources.files import typed_load
from ..sources.logs import OffsetLog
from ..sources.paths import remove_folder, subfolders
from ..sources.tables import DayTable, staged_export

CONCURRENT_SUB_JOBS = 10


@dataclass
class Job:
    """An extraction with an optional load.

    ``extract(start, end)`` gives the rows of an interval. ``new_offset(start, end)``
    gives the offset to store afterwards, None for an interval without rows. Without
    ``initial_offset`` and stored offset a run fails, unless the job is not
    ``incremental``: then it runs once with the current time as its start.
    """

    name: str
    extract: Callable[[object, object], DataFrame]
    new_offset: Callable[[object, object], object] | None = None
    columns: Sequence[tuple[str, str]] = ()
    required: Sequence[str] = ()
    merge_key: str | None = None
    incremental: bool = True
    external_state: bool = True
    initial_offset: str | None = None
    override_offset: str | None = None
    override_end: str | None = None
    include_now: bool = False
    sub_jobs: Sequence["Job"] = field(default_factory=tuple)


def offset_log(spark: SparkSession, root: str) -> OffsetLog:
    return OffsetLog(spark, f"{root}/sql_offset_state")


def stored_offset(spark: SparkSession, root: str, name: str, default=None) -> str | None:
    return offset_log(spark, root).last(name, default)


def job_table(spark: SparkSession, root: str, job: Job) -> DayTable:
    """The table a job with a merge key loads; the key is a date."""
    return DayTable(spark, f"{root}/tables/{job.name}", job.merge_key)


def _staged_paths(spark: SparkSession, stage: str, day: str) -> list[tuple[str]]:
    return [(f"{stage}/date={day}/{folder}/",) for folder in subfolders(spark, f"{stage}/date={day}")]


def _with_folders(intervals: DataFrame) -> DataFrame:
    date, time = folder_names(F.col("batch_start"))
    return intervals.withColumns({"date": date, "time": time})


def _clear_stale(spark: SparkSession, stage: str, interval: Row) -> None:
    """Remove staged folders this interval replaces. Listings are folders of one day."""
    paths = _staged_paths(spark, stage, interval["date"])
    if not paths:
        return
    frame = spark.createDataFrame(paths, "path string")
    found = stale_partitions(frame, interval["batch_start"], interval["first_interval_start"], interval["sets_end"])
    for row in found.collect():
        remove_folder(spark, f"{stage}/{row['folder']}")


def _run_interval(spark: SparkSession, job: Job, root: str, interval: Row, as_of) -> str:
    start, end = interval["batch_start"], interval["batch_end"]
    stage = f"{root}/stage/{job.name}"
    offset = None
    if job.incremental:
        offset = job.new_offset(start, end) if job.new_offset else as_of
        if offset is None:
            return "no rows"
        _clear_stale(spark, stage, interval)
    staged_export(job.extract(start, end), stage, start)
    if job.merge_key:
        folder = f"{stage}/date={interval['date']}/time={interval['time']}"
        batch = typed_load(spark, folder, job.columns, loaded_at=as_of)
        # The days from the batch's first one on; the files of earlier days stay as they are.
        nulls = {f"null in required column {name}": F.col(name).isNull() for name in job.required}
        job_table(spark, root, job).replace(batch, "from", nulls)
    if job.incremental and job.external_state:
        # written last: a run that dies before this repeats the interval
        offset_log(spark, root).record(job.name, f"{start} as of {as_of}", offset, as_of)
    return "loaded"


def run_incremental(spark: SparkSession, job: Job, root: str, as_of) -> list[tuple[str, str]]:
    """Run the sub-jobs, then the job itself; returns (job and start, outcome) pairs.

    Sub-jobs run side by side, so that small ones share the cluster. A failing sub-job
    ends the run once the others have finished.
    """
    outcomes: list[tuple[str, str]] = []
    if job.sub_jobs:
        with ThreadPoolExecutor(CONCURRENT_SUB_JOBS) as pool:
            for result in pool.map(lambda sub: run_incremental(spark, sub, root, as_of), job.sub_jobs):
                outcomes += result
    if job.incremental:
        offset = job.override_offset
        if offset is None and job.external_state:
            offset = stored_offset(spark, root, job.name, job.initial_offset)
        offset = offset or job.initial_offset
        plan = _with_folders(interval_plan(spark, offset, as_of, job.override_end, job.include_now))
        intervals = plan.orderBy("batch_start").collect()  # one row per day to catch up
    else:
        once = spark.range(1).select(
            as_timestamp(job.override_offset or as_of).alias("batch_start"),
            F.lit(None).cast("timestamp").alias("batch_end"),
        )
        intervals = _with_folders(once).collect()
    for interval in intervals:
        outcomes.append((f"{job.name}@{interval['batch_start']}", _run_interval(spark, job, root, interval, as_of)))
    return outcomes
