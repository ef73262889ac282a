"""Outgoing records and messages as tables; posting them is left to a sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.expr import python_str
from ..operators.chunks import ONE_LIST, at_most, chunk_rows, collect_chunks


def feature_records(df: DataFrame, record_id: str) -> DataFrame:
    """One row per feature: (record_id, feature_name, value_as_string).

    Values are text as Python prints them, so a null reads "None".
    """
    entries = [
        F.struct(
            F.lit(name).alias("feature_name"),
            python_str(F.col(f"`{name}`"), data_type).alias("value_as_string"),
        )
        for name, data_type in df.dtypes
    ]
    return df.select(
        F.col(record_id).cast("string").alias("record_id"), F.inline(F.array(*entries))
    )


def feature_record_json(df: DataFrame) -> DataFrame:
    """One row per record: the JSON list of its features, in column order."""
    entries = [
        F.struct(
            F.lit(name).alias("FeatureName"), python_str(F.col(f"`{name}`"), data_type).alias("ValueAsString")
        )
        for name, data_type in df.dtypes
    ]
    return df.select(F.to_json(F.array(*entries)).alias("record"))


def deliver(records: DataFrame, post: Callable[[list], None], batch_size: int = 100, attempts: int = 3) -> None:
    """Send records from the executors in batches; a batch is tried three times.

    ``post`` gets a list of rows. A task that is run again posts its rows again, so
    the receiver must accept a record twice.
    """

    def send(rows) -> None:
        def flush(batch: list) -> None:
            for attempt in range(1, attempts + 1):
                try:
                    return post(batch)
                except Exception:
                    if attempt == attempts:
                        raise

        batch: list = []
        for row in rows:
            batch.append(row)
            if len(batch) == batch_size:
                flush(batch)
                batch = []
        if batch:
            flush(batch)

    records.foreachPartition(send)


def item_messages(
    items: DataFrame, set_col: str, order: Sequence[Column], spread_by: Sequence[str], item: Column, max_items: int | None = None
) -> DataFrame:
    """JSON array of the items of each set, in order.

    A set is one message; one of more than ``max_items`` items, if given, fails the job.
    """
    chunked = chunk_rows(items, ONE_LIST, [set_col], order, spread_by)
    collected = at_most(collect_chunks(chunked, [set_col], {"items": item}), max_items)
    text = F.to_json("items", {"ignoreNullFields": "false"})
    return collected.select(set_col, "chunk_no", "row_count", text.alias("items_json"))


def candidate_messages(
    items: DataFrame, order: Sequence[Column], spread_by: Sequence[str], flow: str, run: str, now_epoch: int,
    expires_in_s: int = fv.MESSAGE_EXPIRY_SECONDS, kind: str = "recommendation", curated: bool = False,
    max_items: int | None = None, sets: Sequence[str] | None = None,
) -> DataFrame:
    """One message per candidate set: (candidate_set_id, message).

    The set id must be a UUID, every item needs an id and a publisher that is not empty,
    and curated items need a feed id; the job fails otherwise, in the pass that builds
    the messages. A set of ``sets``, if given, without items fails it too.
    """
    if expires_in_s <= 0:
        raise ValueError(f"invalid expiry: {expires_in_s}")
    uuid = r"^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"
    set_id = F.col("candidate_set_id")
    bad_id = ~set_id.rlike(uuid)
    checked = F.when(bad_id, F.raise_error(F.concat(F.lit("not a UUID: "), set_id))).otherwise(set_id)
    feed_id = F.col("feed_id")
    if curated:
        feed_id = F.when(
            feed_id.isNull(), F.raise_error(F.lit("a curated item has no feed_id"))
        ).otherwise(feed_id)
    item_id = F.when(F.col("id").isNull(), F.raise_error(F.lit("an item has no id"))).otherwise(F.col("id"))
    publisher = F.col("publisher")
    unnamed = F.raise_error(F.concat(F.lit("no publisher of item "), F.coalesce(F.col("id").cast("string"), F.lit("without id"))))
    publisher = F.when(publisher.isNull() | (publisher == ""), unnamed).otherwise(publisher)
    item = F.struct(item_id.alias("item_id"), publisher.alias("publisher"), feed_id.cast("bigint").alias("feed_id"))
    rows = items.withColumn("candidate_set_id", checked)
    chunked = chunk_rows(rows, ONE_LIST, ["candidate_set_id"], order, spread_by)
    collected = at_most(collect_chunks(chunked, ["candidate_set_id"], {"candidates": item}), max_items)
    if sets is not None:
        wanted = items.sparkSession.createDataFrame([(s,) for s in sets], "candidate_set_id string")
        collected = wanted.join(collected, "candidate_set_id", "left")
        none = F.raise_error(F.concat(F.lit("no items in set "), set_id))
        collected = collected.withColumn("row_count", F.when(F.col("row_count").isNull(), none.cast("bigint")).otherwise(F.col("row_count")))
    message = F.to_json(
        F.struct(
            F.col("candidate_set_id").alias("id"),
            F.lit(fv.MESSAGE_VERSION).alias("version"),
            F.col("candidates"),
            F.lit(kind).alias("type"),
            F.lit(flow).alias("flow"),
            F.lit(run).alias("run"),
            F.lit(now_epoch + expires_in_s).alias("expires_at"),
        ),
        {"ignoreNullFields": "false"},
    )
    return collected.select("candidate_set_id", "chunk_no", "row_count", message.alias("message"))
