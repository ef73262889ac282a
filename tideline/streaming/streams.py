"""Structured Streaming forms of the jobs whose input keeps arriving.

Sinks of ``foreachBatch`` see a batch again after a failure, so each writes its
batch to a folder of its own (``batch=N``) and overwrites it on a repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed_values as fv
from ..operators.counting import sum_when
from ..operators.sketches import pane_sketches, trailing_windows
from ..plans.articles import content_rows, extract_article_text, failure_rows
from ..plans.user_sync import clean_deltas, user_delta_payloads
from ..sources.files import ARTICLE_SCHEMA
from ..sources.logs import OffsetLog


def file_stream(
    spark: SparkSession,
    path: str,
    schema,
    file_format: str = "parquet",
    files_per_trigger: int = fv.FILES_PER_TRIGGER,
    glob: str | None = None,
    clean_source: bool = False,
    archive: str | None = None,
    **options,
) -> DataFrame:
    """Files of a drop folder in micro-batches of a bounded number of files.

    Files of a finished batch are deleted (``clean_source``) or moved below ``archive``
    when a later batch begins; those of the last batch stay until the next run.
    """
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif clean_source:
        reader = reader.option("cleanSource", "delete")
    return reader.options(**options).load(path)


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Write each micro-batch, transformed, to its own folder below ``path``.

    In ``update`` mode a window is written by each batch that changes it, open or closed;
    :func:`newest_rows` reads what stands at the end.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch, batch_id) if transform else batch
        rows.write.mode("overwrite").parquet(_batch_folder(path, batch_id))

    return (
        stream.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The row that the last batch wrote of each key, of batches written in ``update`` mode."""
    rows = spark.read.parquet(path)
    values = F.struct(*[c for c in rows.columns if c not in (*keys, "batch")])
    newest = rows.groupBy(*keys).agg(F.max_by(values, "batch").alias("newest"))
    return newest.select(*keys, "newest.*").select(*[c for c in rows.columns if c != "batch"])


def article_stream(
    spark: SparkSession,
    drop_folder: str,
    content_path: str,
    failures_path: str,
    checkpoint: str,
    run_id: str,
    loaded_at,
    convert=None,
    files_per_trigger: int = fv.FILES_PER_TRIGGER,
    clean_source: bool = True,
) -> StreamingQuery:
    """Article objects to content rows and dead letters, batch by batch.

    The converted batch is written once and read back for both outputs, so the
    parser runs once and a lost executor repeats only its own part.
    """
    objects = file_stream(
        spark, drop_folder, ARTICLE_SCHEMA, "json", files_per_trigger, clean_source=clean_source
    ).withColumn("object_key", F.col("_metadata.file_path"))
    arguments = {} if convert is None else {"convert": convert}

    def sink(batch: DataFrame, batch_id: int) -> None:
        staged = _batch_folder(f"{content_path}/_converted", batch_id)
        extract_article_text(batch, **arguments).write.mode("overwrite").parquet(staged)
        converted = spark.read.parquet(staged)
        content_rows(converted, loaded_at).write.mode("overwrite").parquet(
            _batch_folder(f"{content_path}/rows", batch_id)
        )
        failures = failure_rows(converted, run_id, run_id, batch_id, loaded_at)
        failures.write.mode("overwrite").json(_batch_folder(failures_path, batch_id))

    return (
        objects.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def change_feed_stream(
    changes: DataFrame, path: str, checkpoint: str, environment: str, log: OffsetLog | None = None, name: str = "user_deltas", now=None
) -> StreamingQuery:
    """User changes to request payloads; the checkpoint takes the place of the offset.

    With ``log``, the latest load time of each batch is added to it as the offset of
    ``name``, and a batch that it holds already is not written again: so the job can also
    go on without its checkpoint, from the logged offset.
    """

    def payloads(batch: DataFrame, _: int) -> DataFrame:
        deltas = clean_deltas(batch, "1970-01-01 00:00:00", production=environment == "production")
        return user_delta_payloads(deltas, environment)

    if log is None:
        return write_batches(changes, path, checkpoint, payloads)

    def sink(batch: DataFrame, batch_id: int) -> str | None:
        payloads(batch, batch_id).write.mode("overwrite").parquet(_batch_folder(path, batch_id))
        return batch.agg(F.max("loaded_at").cast("string")).first()[0]

    return (
        changes.writeStream.foreachBatch(log.once(name, sink, now))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


TRAILING = ["trailing_1_day_impressions", "trailing_1_day_opens"]


def engagement_pane_stream(
    events: DataFrame, ts_col: str, key_col: str, name_col: str, document_col: str,
    pane: str = "15 minutes", late: str = "1 hour",
) -> DataFrame:
    """Sketches of the viewing and the opening documents per pane and key; :func:`trailing_engagement` unites them.

    Each event changes the one sketch of its pane. Append mode leaves out the panes still
    open when the input ends; write it in ``update`` mode for all of them.
    """
    documents = {
        name: F.when(F.col(name_col) == event, F.col(document_col))
        for name, event in zip(TRAILING, ("impression", "click"), strict=True)
    }
    return pane_sketches(events.withWatermark(ts_col, late), ts_col, [key_col], documents, pane)


def trailing_engagement(panes: DataFrame, key_col: str, length: int = 86400, slide: int = 900) -> DataFrame:
    """Approximate viewing and opening documents per key over a sliding window, from the panes of a stream or a batch."""
    return trailing_windows(panes, [key_col], TRAILING, length, slide)


def deduplicated_stream(events: DataFrame, ts_col: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """First arrival of each key within the watermark.

    It keeps the first, where the batch job keeps the latest row.
    """
    return events.withWatermark(ts_col, late).dropDuplicatesWithinWatermark(keys)


def latest_stream(
    events: DataFrame, ts_col: str, keys: list[str], tie_break: list[str] = (), period: str = "1 day", late: str = "1 day"
) -> DataFrame:
    """Latest row per period and key, whatever the order of arrival: the batch job's rule as a stream.

    The state holds one row per open period and key; a re-delivered row changes nothing.
    In append mode a row appears once the watermark has passed its period; in ``update``
    mode :func:`newest_rows` gives also those of the periods still open.
    """
    row, order = F.struct(*events.columns), F.struct(ts_col, *tie_break)
    # The grouping's names must not meet those of the row.
    named = events.withColumns({f"_key_{i}": F.col(k) for i, k in enumerate(keys)})
    latest = (
        named.withWatermark(ts_col, late)
        .groupBy(F.window(ts_col, period).alias("_period"), *[f"_key_{i}" for i in range(len(keys))])
        .agg(F.max_by(row, order).alias("_row"))
    )
    return latest.select(F.col("_period.start").alias("period_start"), "_row.*")


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB instead of the executors' heap.

    A batch then writes what it changed; whole snapshots are written beside the batches.
    """
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def second_count_stream(
    events: DataFrame, ts_col: str, keys: list[str], is_click, late: str = "1 hour"
) -> DataFrame:
    """Rows and clicks per second and key, click spam included."""
    return (
        events.withWatermark(ts_col, late)
        .groupBy(F.window(ts_col, "1 second").alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("rows"), sum_when(is_click).alias("clicks"))
        .select(F.col("window.start").alias("second"), *keys, "rows", "clicks")
    )


def without_click_spam(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("clicks") < fv.MAX_CLICKS_PER_SECOND)


def second_click_stream(
    events: DataFrame, ts_col: str, keys: list[str], is_click, late: str = "1 hour"
) -> DataFrame:
    """Counts per second and key without click spam, for windows the watermark has closed.

    For all windows, write :func:`second_count_stream` in ``update`` mode and filter the
    newest rows: an open window may still turn out to be spam.
    """
    return without_click_spam(second_count_stream(events, ts_col, keys, is_click, late))
