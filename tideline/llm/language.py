"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte n-grams of lengths 1 to 3, weighted by TF-IDF and
scaled to length one. Document frequencies come from all training texts; the centroids of
a language come from spherical k-means over a bounded sample of its training texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_batches

DIMENSIONS = 4096
CENTROIDS = 4
#: Training texts, over all languages, from which the centroids are fitted (the bound of the sample; one of each language at least).
SAMPLE_TEXTS = 4000
ROUNDS = 12
#: A text is rejected if it is farther than this many times its centroid's 99th percentile of training distances.
REJECT = 1.25
UNKNOWN = "und"
_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text))


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of the hashed n-grams, a row per text; n-grams never cross texts."""
    raw = [t.encode().lower() for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    buffer = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(raw), dtype=np.int64), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(buffer))
    counts = np.zeros(len(raw) * DIMENSIONS, np.int64)
    value = np.zeros(len(buffer), np.uint32)
    for n in range(1, 4):
        value = value[: len(buffer) - n + 1] * np.uint32(0x01000193) + buffer[n - 1 :] + np.uint32(n)
        inside = left[: len(value)] >= n
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        bucket = (mixed >> np.uint32(20)).astype(np.int64)
        counts += np.bincount((row[: len(value)] * DIMENSIONS + bucket)[inside], minlength=len(counts))
    return counts.reshape(len(raw), DIMENSIONS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors; a row without n-grams stays zero."""
    weighted = np.log1p(counts).astype(np.float32) * idf.astype(np.float32)
    norm = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(norm > 0, norm, 1)


@dataclass
class Centroids:
    """The model: bounded by languages times centroids times dimensions."""

    idf: np.ndarray
    languages: list[str]
    centres: np.ndarray
    reach: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and whether the distance is beyond the centroid's reach."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        known = np.array([has_letter(t) for t in texts], bool)
        cosine = vectors(gram_counts(texts), self.idf) @ self.centres.T
        best = cosine.argmax(axis=1)
        top = np.clip(cosine[np.arange(len(texts)), best].astype(float), 0.0, 1.0)
        far = 1 - top > self.reach[best]
        return (
            [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
            np.where(known, top, 0.0),
            far | ~known,
        )


def _clusters(points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; centres start at points far from those chosen before."""
    centres = [points.mean(axis=0)]
    centres[0] /= np.linalg.norm(centres[0]) or 1
    for _ in range(min(k, len(points)) - 1):
        centres.append(points[(points @ np.array(centres).T).max(axis=1).argmin()])
    centre = np.array(centres)
    for _ in range(ROUNDS):
        own = (points @ centre.T).argmax(axis=1)
        for c in range(len(centre)):
            if (own == c).any():
                total = points[own == c].sum(axis=0)
                centre[c] = total / (np.linalg.norm(total) or 1)
    return centre, (points @ centre.T).argmax(axis=1)


def train(docs: DataFrame, training: Column, label: str = "lang", text: str = "text", id_col: str = "doc_id") -> Centroids:
    """Fits the model on the rows where ``training`` holds and the label is not null.

    Rows whose text is null or has no letter teach nothing. Languages without a row are
    not learned; without any, the model knows none.
    """
    rows = docs.filter(training & F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(id_col).alias("spread"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(DIMENSIONS, np.int64), 0
        for _, texts in text_batches(batches):
            usable = [t for t in texts if has_letter(t)]
            if usable:
                found += (gram_counts(usable) > 0).sum(axis=0)
                n += len(usable)
        # The last row counts the texts themselves.
        yield pa.RecordBatch.from_pydict({"gram": list(range(DIMENSIONS + 1)), "n": [*found.tolist(), n]})

    totals = rows.select("text").mapInArrow(frequencies, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    seen = np.zeros(DIMENSIONS + 1)
    for row in totals.collect():
        seen[row["gram"]] = row["n"]
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1

    # Every language gives as many texts, the first by a hash. Those that can be among them are picked where they are, by
    # a rate that leaves some four times as many; so what meets in a language's task is bounded, and no language is lost.
    share = max(1, SAMPLE_TEXTS // max(1, rows.select("label").distinct().count()))
    rate = (4.0 * share + 64.0) / F.col("n")
    place = F.shiftrightunsigned("spread", 11).cast("double") / F.lit(float(1 << 53))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("place", "text"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            names = batch.column(0).to_pylist()
            for name, value in zip(names, texts, strict=True):
                if has_letter(value):
                    vector = vectors(gram_counts([value]), idf)[0]
                    yield pa.RecordBatch.from_pydict({"label": [name], "vector": [vector.astype("<f4").tobytes()]})

    usable = rows.filter(F.col("text").rlike(r"\p{L}"))
    sizes = usable.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # A row per language: far less than the model, which every task gets as well.
    picked = usable.withColumn("place", place).join(F.broadcast(sizes), "label").filter(F.col("place") < rate)
    drawn = picked.withColumn("rank", rank).filter(F.col("rank") <= share).select("label", "text")
    points: dict[str, list[bytes]] = {}
    for row in drawn.mapInArrow(sample, "label string, vector binary").collect():
        points.setdefault(row["label"], []).append(bytes(row["vector"]))
    languages: list[str] = []
    centres: list[np.ndarray] = []
    reach: list[float] = []
    for name in sorted(points):
        own = np.frombuffer(b"".join(sorted(points[name])), "<f4").reshape(-1, DIMENSIONS)
        centre, member = _clusters(own, CENTROIDS)
        for c in range(len(centre)):
            if (member == c).any():
                languages.append(name)
                centres.append(centre[c])
                reach.append(REJECT * float(np.quantile(1 - own[member == c] @ centre[c], 0.99)))
    stacked = np.array(centres, np.float32).reshape(-1, DIMENSIONS)
    return Centroids(idf.astype(np.float32), languages, stacked, np.array(reach))


def identify(docs: DataFrame, model: Centroids, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with ``lang_pred``, ``score`` and ``rejected``, for every row of ``docs``.

    ``lang_pred`` is the language of the nearest centroid, ``und`` for a null text, a text
    without a letter, or a model that knows no language. ``score`` is the cosine (0 for
    ``und``). ``rejected`` tells that the text is farther from its centroid than nearly
    all training texts were; the nearest language is still named. Only the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "_text"):
            names, score, far = shared.value.predict(texts)
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score", "rejected"])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, "lang_pred string", "score double", "rejected boolean"])
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(predict, schema)


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Trains on two of three folds by crc32 of the id and predicts every row; ``held_out`` marks the third.

    A null text or one without a letter is ``und`` with score 0, and so is every row if no
    language is learned; a null id is not held out; rows that repeat get equal predictions;
    of equally near centroids the first by language counts; an empty table gives an empty
    result; other columns are ignored.
    """
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    marked = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = train(marked, ~F.col("held_out"))
    return identify(marked, model, keep=("doc_id", "held_out"))
