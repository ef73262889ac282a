"""Table maintenance as pure functions: (target, batch) -> new target.

Plain Parquet tables know neither DELETE nor MERGE, so every change is the plan of
the table's next state; :mod:`tideline.sources.tables` writes it. Keys follow SQL:
a null key matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import as_timestamp
from .checks import not_null
from .latest import latest_per_key


def newer_than_target(source: DataFrame, target: DataFrame, ts_col: str, default_since) -> DataFrame:
    """Rows of ``source`` after the latest time in ``target``, or after ``default_since``
    for an empty target. The bound is one scalar, so nothing is joined."""
    latest = target.select(F.max(ts_col)).scalar()
    return source.filter(F.col(ts_col) > F.coalesce(latest, as_timestamp(default_since)))


def range_replace(target: DataFrame, batch: DataFrame, key: str, required: Sequence[str] = ()) -> DataFrame:
    """Drop the target's rows from the batch's least key on, then add the batch.

    An empty batch has no least key and changes nothing.
    """
    batch = not_null(batch, required) if required else batch
    least = batch.select(F.min(key)).scalar()
    replaced = F.coalesce(F.col(key) >= least, F.lit(False))
    return target.filter(~replaced).unionByName(batch, allowMissingColumns=True)


#: Most values that the key of :func:`key_replace` may have in a batch.
MAX_KEYS = 100_000


def key_replace(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Drop the target's rows whose key occurs in the batch, then add the batch.

    ``key`` has few values, as days have: those of the batch are one array, so the
    target's rows are filtered where they are and a hot key moves nothing. A batch with
    more than :data:`MAX_KEYS` values fails the job.
    """
    few = batch.select(key).distinct().limit(MAX_KEYS + 1)
    held = few.select(F.collect_set(key)).scalar()
    many = F.raise_error(F.lit(f"more than {MAX_KEYS} values of {key} in the batch")).cast("boolean")
    replaced = F.coalesce(F.when(F.size(held) > MAX_KEYS, many).otherwise(F.array_contains(held, F.col(key))), F.lit(False))
    return target.filter(~replaced).unionByName(batch, allowMissingColumns=True)


def full_refresh(batch: DataFrame, columns: Sequence[str], loaded_at, loaded_at_col: str) -> DataFrame:
    """All rows anew, as text, with the time of the load."""
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    return batch.select(*texts, as_timestamp(loaded_at).alias(loaded_at_col))


def joinable(key: Column, side: str = "target") -> Column:
    """The key as text; null keys get texts the other side does not hold, one per input
    partition, so that a large share of null keys is no hot partition."""
    return F.coalesce(key.cast("string"), F.concat(F.lit(f"\u0000{side}-"), F.spark_partition_id().cast("string")))


def _with_join_keys(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    return df.withColumns({f"_key_{i}": joinable(F.col(key), side) for i, key in enumerate(keys)})


def _single(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; a key without nulls that is held twice fails the job."""
    known = F.lit(True)
    for key in keys:
        known &= F.col(key).isNotNull()
    rows = batch.filter(known).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.first(F.struct(*batch.columns)).alias("_row")
    )
    twice = F.raise_error(F.concat(F.lit("key held twice by the batch: "), F.to_json(F.struct(*keys))))
    once = rows.filter(F.when(F.col("_rows") > 1, twice.cast("boolean")).otherwise(F.lit(True)))
    return once.select("_row.*").unionByName(batch.filter(~known))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_only_cols: Sequence[str] = (),
) -> DataFrame:
    """Update matching rows, insert the others.

    ``insert_only_cols`` are set for new rows and kept for old ones. A key that the
    batch holds twice fails the job; a null key matches nothing.
    """
    old = _with_join_keys(target, keys, "target").withColumn("_in_target", F.lit(True)).alias("t")
    new = _with_join_keys(_single(batch, keys), keys, "batch").withColumn("_in_batch", F.lit(True)).alias("b")
    condition = None
    for i in range(len(keys)):
        equal = F.col(f"t._key_{i}") == F.col(f"b._key_{i}")
        condition = equal if condition is None else condition & equal
    joined = old.join(new, condition, "full_outer")
    in_target, in_batch = F.col("t._in_target").isNotNull(), F.col("b._in_batch").isNotNull()

    def result(column: str) -> Column:
        before, after = F.col(f"t.{column}"), F.col(f"b.{column}") if column in batch.columns else None
        if column in update_cols:
            chosen = F.when(in_batch, after).otherwise(before)
        elif column in keys or column in insert_only_cols:
            chosen = F.when(in_target, before).otherwise(after)
        else:
            chosen = before
        return chosen.alias(column)

    return joined.select(*[result(c) for c in target.columns])


def purge(
    target: DataFrame,
    keys: DataFrame,
    pairs: Sequence[tuple[Column | str, str]],
    only_if: Column | None = None,
) -> DataFrame:
    """Rows of ``target`` whose key is not in ``keys``.

    ``pairs`` lists (target column or expression, key column). Several pairs mean
    OR and run as one anti-join each: an OR condition would compare every row with
    every key. ``only_if`` restricts the deletion to rows where it holds.
    """
    names = list(target.columns)
    for expression, key_col in pairs:
        own = F.col(expression) if isinstance(expression, str) else expression
        if only_if is not None:
            own = F.when(only_if, own)
        left = target.withColumn("_purge_key", joinable(own))
        right = keys.filter(F.col(key_col).isNotNull()).select(F.col(key_col).cast("string").alias("_purge_key"))
        target = left.join(right, "_purge_key", "left_anti").select(*names)
    return target


def purge_flagged(target: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag is not true; an unknown flag keeps the row."""
    return target.filter(~F.coalesce(F.col(flag), F.lit(False)))


def new_keys(source: DataFrame, known: DataFrame, key_cols: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Distinct keys of ``source`` not yet in ``known``.

    A key with a null part matches nothing and is returned each time, unless
    ``null_safe``.
    """
    distinct = source.select(*key_cols).distinct().alias("s")
    known = known.select(*key_cols).alias("k")
    condition = None
    for key in key_cols:
        left, right = F.col(f"s.{key}"), F.col(f"k.{key}")
        equal = left.eqNullSafe(right) if null_safe else left == right
        condition = equal if condition is None else condition & equal
    return distinct.join(known, condition, "left_anti")


def compact_latest(df: DataFrame, key: str, order_col: str, as_of, tie_break=()) -> DataFrame:
    """Latest row per key, stamped with the time of the compaction."""
    latest = latest_per_key(df, key, order_col, tie_break)
    return latest.withColumn("last_ordered", as_timestamp(as_of))


def clustered(df: DataFrame, key: str, spread_by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Rows in ranges of ``key``, sorted within each file-to-be.

    ``spread_by`` splits the range of a key that holds many rows.
    """
    columns = [key, *spread_by]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def last_offset(state: DataFrame, name: str, default) -> DataFrame:
    """The stored offset of a job, or the default where it has none."""
    found = state.filter(F.col("sql_folder_name") == name).agg(F.max("last_offset").alias("last_offset"))
    return found.select(F.coalesce("last_offset", F.lit(default).cast("string")).alias("last_offset"))


def upsert_offset(state: DataFrame, name: str, offset, now) -> DataFrame:
    """Offset table with the job's new offset; the row's creation time is kept."""
    spark = state.sparkSession
    row = spark.range(1).select(
        F.lit(name).alias("sql_folder_name"),
        as_timestamp(now).alias("created_at"),
        as_timestamp(now).alias("updated_at"),
        F.lit(offset).cast("string").alias("last_offset"),
    )
    return upsert(state, row, ["sql_folder_name"], ["updated_at", "last_offset"], ["created_at"])
