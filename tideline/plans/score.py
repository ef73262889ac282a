"""Content scores: pseudo-counts, lower quantiles, routing and queue upkeep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.beta import beta_quantiles
from ..operators.setops import without_match
from ..operators.tables import new_keys, upsert
from ..session import materialized

KEYS = ["publisher_id", "content_id"]
_COUNTS = ["save_cnt", "open_cnt", "favorite_cnt", "share_cnt"]
_PSEUDO = ["open_uv", "open_dv", "fav_uv", "fav_dv", "share_uv", "share_dv"]
_SCORES = ["open_score", "favorite_score", "share_score", "total_score"]
RESULT = [*KEYS, "save_cnt", *_PSEUDO, *_SCORES]


def move_to_queue(queue: DataFrame, holding: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queue with the new keys of the holding table, and the emptied holding table."""
    added = new_keys(holding, queue, KEYS)
    return queue.select(*KEYS).unionByName(added), holding.limit(0)


def _down(total: Column, part: Column, up: Column, prior: float) -> Column:
    """Pseudo-count of misses; more hits than tries count fourfold against a row."""
    misses = (total.cast("double") - part) + F.lit(prior)
    return F.when(total >= part, misses).otherwise((misses + up) * 4)


def content_score_inputs(queue: DataFrame, lifetime: DataFrame, limit: int | None = None) -> DataFrame:
    """Pseudo-counts of the next batch of the queue.

    The batch is the whole queue, or the first ``limit`` rows of it that can be scored.
    Rows without counters, or with none above zero, are not scored.
    """
    rows = queue.select(*KEYS).join(lifetime.select(*KEYS, *_COUNTS), KEYS, "inner").select(
        *[F.col(k).cast("bigint").alias(k) for k in KEYS],
        *[F.col(c).cast("bigint").alias(c) for c in _COUNTS],
    )
    known, positive = F.lit(True), F.lit(False)
    for count in _COUNTS:
        known = known & F.col(count).isNotNull()
        positive = positive | (F.col(count) > 0)
    saves, opens, favorites, shares = (F.col(c) for c in _COUNTS)
    scorable = rows.filter(known & positive)
    if limit is not None:
        # Cut after the test, so that rows that cannot be scored hold up no others.
        scorable = scorable.orderBy(*KEYS).limit(limit)
    with_up = scorable.withColumns(
        {
            "open_uv": opens.cast("double") + 2.2 + saves * 0.05,
            "fav_uv": favorites.cast("double") + 0.2 + opens * 0.02,
            "share_uv": shares.cast("double") + 0.2 + opens * 0.02,
        }
    )
    return with_up.withColumns(
        {
            "open_dv": _down(saves, opens, F.col("open_uv"), 7.8),
            "fav_dv": _down(opens, favorites, F.col("fav_uv"), 9.8),
            "share_dv": _down(opens, shares, F.col("share_uv"), 9.8),
        }
    ).select(*KEYS, *_COUNTS, *_PSEUDO)


def content_score(inputs: DataFrame) -> DataFrame:
    """Scores: the 10 % quantile of each rate and their weighted mean.

    Counts are small numbers that many contents share: the inputs are written once, each
    distinct pair of pseudo-counts is solved once and joined back.
    """
    p = 1.0 / (1 + fv.SCORE_LOSS_MULTIPLE)
    scored = materialized(inputs, "score-inputs")
    rates = {"open_score": ("open_uv", "open_dv"), "favorite_score": ("fav_uv", "fav_dv"), "share_score": ("share_uv", "share_dv")}
    pairs = reduce(DataFrame.unionByName, [scored.select(F.col(up).alias("a"), F.col(down).alias("b")) for up, down in rates.values()])
    solved = materialized(beta_quantiles(pairs, p), "score-quantiles")
    for name, (up, down) in rates.items():
        scored = scored.join(solved.select(F.col("a").alias(up), F.col("b").alias(down), F.col("quantile").alias(name)), [up, down])
    weights = fv.SCORE_WEIGHTS
    weighted = sum((F.col(f"{name}_score") * weight for name, weight in weights.items()), F.lit(0.0))
    return scored.withColumn("total_score", weighted / sum(weights.values())).select(*RESULT)


def load_scores(
    small_ids: DataFrame, large_ids: DataFrame, queue: DataFrame, scores: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New states of the two score tables and of the queue.

    Scores go to one table or the other by the size of the content id, rounded to
    four places. Scored keys leave the queue; unscored ones stay.
    """
    rounded = scores.withColumns({s: F.round(s, 4) for s in _SCORES})
    is_small = F.col("content_id") <= fv.SCORE_MAX_SMALL_ID
    updated = [c for c in RESULT if c not in KEYS]
    return (
        upsert(small_ids, rounded.filter(is_small), KEYS, updated),
        upsert(large_ids, rounded.filter(~is_small), KEYS, updated),
        without_match(queue, scores, KEYS),
    )
