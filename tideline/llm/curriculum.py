"""Mixes sources to target weights along a curriculum; DataFrame expressions only.

How much of a source is taken follows from its weight: the shares fill up by weight, none
above a number of passes over its source, and what that leaves is shared out again. When it
is taken follows from its schedule: a source's density over training time t in [0, 1] is
``1 + slope * (2 t - 1)``; its integral, times the target, is the source's cumulative
demand, and a document stands where the demand reaches its middle word. Documents that
the demand does not reach are not taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, running_totals, spread_key, written

#: Weights of the sources in their order, and slopes of their schedules; both repeat.
WEIGHTS = (5, 2, 1)
SLOPES = (-0.5, 0.0, 0.5)
#: Words of the mix by words of all documents, and the most passes over one source.
SHARE = 1.5
PASSES = 2


def _cycle(number, values: tuple):
    """The value whose place is ``number`` modulo the number of values."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """Words to take of each source, from rows (``source``, ``source_size``) of which each source has one.

    Filling by weight with a cap ends at one level: sources whose cap lies below level
    times weight get their cap, the others level times weight. Ordered by cap through
    weight, the level behind the first k sources is (total - their caps) / (weights of
    the rest); the sources are capped up to the first k at which the next one is not.
    One row per source goes through one window.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("place", place).withColumn("weight", _cycle(F.col("place"), weights))
    cap = F.lit(float(passes)) * F.col("source_size")
    rows = rows.withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    # The level at the first source that is not capped holds for all behind it.
    final = F.min(F.when(F.col("free"), F.struct("ratio", "place", "level"))).over(Window.partitionBy())
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("final", final)
    capped = F.col("final").isNull() | (F.struct("ratio", "place") < F.struct("final.ratio", "final.place"))
    target = F.when(capped, F.col("cap")).otherwise(F.col("final.level") * F.col("weight"))
    return rows.select("source", "source_size", "place", target.alias("target"))


def _position(words, target, slope):
    """Training time in [0, 1] at which a source's demand reaches ``words``; null where it never does.

    The inverse of the schedule's integral, t + slope * (t * t - t), as a part of the target.
    """
    part = words / target
    bent = (slope - 1 + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * part)) / (2 * slope)
    time = F.when(slope == 0, part).otherwise(F.greatest(F.lit(0.0), F.least(bent, F.lit(1.0))))
    return F.when((target > 0) & (words <= target), time)


def curriculum(
    docs: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, share: float = SHARE, passes: int = PASSES
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``,
    ``passes``, ``position`` and ``positions``.

    ``size`` is the number of words of ``text`` (null: 0). A source's documents stand in an
    order spread by a hash of the id, one pass behind the other, and the cumulative demand
    is inverted at the middle of each: ``positions`` holds the training time of every pass
    that the demand reaches, so that the words taken end nearest to the target; ``passes``
    is their number, ``taken`` the words they take, ``position`` the first (null: none). A
    null source is a source of its own and the last; rows that repeat are documents of
    their own, ordered alike each time; empty texts have positions but take no words; a
    source without words has none; an empty table gives an empty result; columns other
    than ``doc_id``, ``source`` and ``text`` are ignored. Every step is a DataFrame
    operation; a hot source is summed bucket by bucket.
    """
    return _placed(docs, weights, slopes, share, passes).drop("_text_hash")


def _placed(docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, share=SHARE, passes=PASSES) -> DataFrame:
    """:func:`curriculum` with a hash of the text, which tells rows of one id apart."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")
    sized = docs.select(
        "doc_id", "source", size.alias("size"), spread_key("doc_id").alias("key"), F.xxhash64("text").alias("_text_hash")
    )
    sized = written(sized, "curriculum-sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, passes)
    ordered = running_totals(sized, ["source"], "key", ["doc_id", "size", "_text_hash"], "size", sized.count())
    t = targets.select(F.col("source").alias("_source"), "source_size", "place", "target")
    rows = ordered.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("slope", _cycle(F.col("place"), slopes))

    def time(number):
        middle = (2 * (F.col("before") + number * F.col("source_size")) + F.col("size")).cast("double") / 2
        return _position(middle, F.col("target"), F.col("slope"))

    times = F.array(*[time(F.lit(k).cast("bigint")) for k in range(passes)])
    rows = rows.withColumn("positions", F.filter(times, lambda t: t.isNotNull()))
    number = F.size("positions")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", (number * F.col("size")).cast("bigint").alias("taken"),
        number.alias("passes"), F.get("positions", F.lit(0)).alias("position"), "positions", "_text_hash",
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every pass over a document as a row of its own, range-sorted by training position.

    Columns: ``doc_id``, ``source``, ``size``, ``pass`` (from 0) and ``position``.
    """
    rows = curriculum(docs, **options).select("doc_id", "source", "size", F.posexplode("positions").alias("pass", "position"))
    return rows.orderBy("position", "doc_id", "pass")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, as the mix takes them: as often as it passes over them, sorted by position.

    Rows alike in id, source and text are taken as often as the first of them, at its
    positions; a null id is an id.
    """
    taken = _placed(docs, **options).filter("passes > 0").groupBy("doc_id", "source", "_text_hash").agg(
        F.min("positions").alias("_positions")
    )
    taken = taken.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("_text_hash").alias("_hash"), "_positions"
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & F.col("_row.source").eqNullSafe(F.col("_source"))
    rows = whole.join(taken, same & (F.xxhash64("_row.text") == F.col("_hash")))
    rows = rows.select("_row", "_id", F.posexplode("_positions").alias("_pass", "_position"))
    return rows.orderBy("_position", "_id", "_pass").select("_row.*")
