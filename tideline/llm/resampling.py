"""Quality selection by importance resampling over hashed n-grams.

Two generative models, bags of hashed word unigrams and bigrams, are counted: one of a
target (texts labelled good), one of all raw texts. A document's importance weight is the
ratio of its probabilities under the two; Gumbel noise on the log weights and a top-k then
draw documents without replacement in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, written

BUCKETS = 1 << 14
#: Labelled good documents the target model is counted from (the bound of the sample, drawn by a hash of the id).
TARGET_TEXTS = 20_000
#: Added to each bucket's count, per bucket.
SMOOTHING = 1.0
#: The k-th key is looked for among this many rows at most.
BAND = 50_000


def hashed_grams(text: str) -> np.ndarray:
    """Buckets of a text's words and of its pairs of neighbouring words."""
    words = text.encode().split()
    if not words:
        return np.empty(0, np.int64)
    word = np.fromiter(map(crc32, words), np.uint64, len(words))
    pair = word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    single = word * np.uint64(0xD6E8FEB86659FD93)
    return (np.concatenate([single, pair]) >> np.uint64(50)).astype(np.int64)


def log_ratio(docs: DataFrame, labels: DataFrame, text: str = "text") -> np.ndarray:
    """Log of each bucket's probability in the target over that in all texts; zeros if nothing is labelled good."""
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    n = good.count()
    share = min(1.0, TARGET_TEXTS / max(n, 1))
    chosen = good.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    # Bounded by TARGET_TEXTS ids.
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("_good")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch, texts in text_batches(batches, "text"):
            for target, value in zip(batch.column(0).to_pylist(), texts, strict=True):
                found = np.bincount(hashed_grams(value), minlength=BUCKETS)
                counts[0] += found
                if target:
                    counts[1] += found
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), *map(pa.array, counts)], ["bucket", "raw", "target"])

    # Only the two columns, under names of their own, meet the labels.
    texts = docs.select(F.col("doc_id").alias("_id"), F.col(text).alias("_text"))
    marked = texts.join(chosen, F.col("_id") == F.col("_good"), "left").select(F.col("_good").isNotNull().alias("good"), F.col("_text").alias("text"))
    sums = marked.mapInArrow(count, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    counts = np.zeros((2, BUCKETS))
    for bucket, raw, target in sums.collect():
        counts[:, bucket] = raw, target
    if not counts[1].any():
        return np.zeros(BUCKETS)
    shares = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(shares[1]) - np.log(shares[0])


def weighted(docs: DataFrame, ratio: np.ndarray, seed: int = 0, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_grams``, ``log_weight``, ``score`` (a logistic of the weight per n-gram) and ``key`` with Gumbel noise."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            grams = [hashed_grams(t) for t in texts]
            weights = [float(shared.value[g].sum()) for g in grams]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(g) for g in grams], pa.int64()), pa.array(weights, pa.float64())],
                ["doc_id", "n_grams", "log_weight"],
            )

    rows = docs.select("doc_id", F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(weigh, f"doc_id {kind}, n_grams bigint, log_weight double")
    mean = F.when(F.col("n_grams") > 0, F.col("log_weight") / F.col("n_grams")).otherwise(F.lit(0.0))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    rows = rows.withColumn("score", 1 / (1 + F.exp(-mean)))
    return rows.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def kth_key(rows: DataFrame, k: int) -> float | None:
    """The ``k``-th largest ``key`` of ``rows``, exactly: two quantiles part the rows, and the part that holds it goes on.

    A key that many rows share is a quantile itself and is left behind, so each turn leaves fewer rows.
    """
    key = F.col("key")
    while True:
        n = rows.count()
        if n <= BAND:
            found = rows.select("key").orderBy(F.desc("key")).offset(k - 1).limit(1).collect()
            return found[0]["key"] if found else None
        wanted = 1 - k / n
        low, high = rows.approxQuantile("key", [max(0.0, wanted - 0.01), min(1.0, wanted + 0.01)], 0.002)
        parts = [key > high, key == high, (key > low) & (key < high), (key == low) & (key < high), key < low]
        counts = rows.agg(*[F.count_if(part).alias(f"n{i}") for i, part in enumerate(parts)]).first()
        for i, part in enumerate(parts):
            if k <= counts[i]:
                break
            k -= counts[i]
        else:
            return None
        if i in (1, 3):
            return high if i == 1 else low
        rows = rows.filter(part)


def importance_resample(docs: DataFrame, labels: DataFrame, fraction: float | None = None, seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score``, ``log_weight`` and ``kept``.

    ``kept`` marks the ``fraction`` of all rows with the largest Gumbel keys; by default
    the share of good ones among ``labels`` (``doc_id``, ``quality`` 0 or 1, null quality
    says nothing). Without labels all weights are equal and every row is kept. A null text
    counts as empty; a text without a word has weight 0. Rows that share an id and a text
    are kept or dropped together, so are rows with equal keys at the border. An empty
    table gives an empty result; other columns are ignored. Labels of other than 1 are
    not good ones; the default fraction is the mean of ``quality``.
    """
    ratio = log_ratio(docs, labels)
    rows = written(weighted(docs, ratio, seed), "importance")
    if fraction is None:
        row = labels.filter("quality is not null").agg(F.avg("quality").alias("share")).first()
        fraction = 1.0 if row["share"] is None else float(row["share"])
    n = rows.count()
    k = min(n, round(fraction * n))
    border = kth_key(rows, k) if k else None
    kept = F.lit(False) if border is None else F.col("key") >= border
    return rows.select("doc_id", "score", "log_weight", kept.alias("kept"))
