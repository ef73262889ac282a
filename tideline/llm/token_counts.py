"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of the lengths of frequent pre-tokens, broadcast once; tier two
is a cache each worker fills by encoding what the table lacks. No pre-token is shuffled:
the table comes from one bounded sketch per partition, merged by tree, and only decides
how fast a length is found, never which length.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import text_batches

#: Entries of a partition's sketch and of the broadcast table.
SKETCH_PIECES = 1 << 14
FREQUENT_PIECES = 1 << 15
#: Sketches that one task merges at once.
FAN_IN = 16


def _pruned(counts: Counter, size: int) -> Counter:
    return Counter(dict(counts.most_common(size)))


def frequent_pieces(docs: DataFrame, path: str, text: str = "text") -> list[str]:
    """The most frequent pre-tokens of all texts, about :data:`FREQUENT_PIECES` at most.

    Each partition counts its pre-tokens in a bounded counter and hands on one row; the
    rows are merged :data:`FAN_IN` at a time, in as many rounds as it takes.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        splitter = tokens.splitter(path)
        counts: Counter = Counter()
        for _, texts in text_batches(batches, text):
            for value in texts:
                counts.update(splitter.split(value) or ())
            if len(counts) > 16 * SKETCH_PIECES:
                counts = _pruned(counts, 4 * SKETCH_PIECES)
        top = [(p, n) for p, n in counts.most_common(SKETCH_PIECES) if len(p) <= tokens.KEPT_LENGTH and "\x00" not in p]
        yield pa.RecordBatch.from_pydict(
            {"part": [TaskContext.get().partitionId()], "piece": [[p for p, _ in top]], "n": [[n for _, n in top]]},
            schema=pa.schema([("part", pa.int32()), ("piece", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))]),
        )

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        counts: Counter = Counter()
        for pieces, numbers in zip(rows["piece"], rows["n"], strict=True):
            for p, n in zip(pieces, numbers, strict=True):
                counts[p] += int(n)
        top = counts.most_common(FREQUENT_PIECES)
        return pd.DataFrame({"part": [key[0]], "piece": [[p for p, _ in top]], "n": [[n for _, n in top]]})

    schema = "part int, piece array<string>, n array<bigint>"
    level = docs.select(text).mapInArrow(sketch, schema)
    left = max(2, docs.rdd.getNumPartitions())
    while left > 1:
        left = -(-left // FAN_IN)
        level = level.groupBy(F.floor(F.col("part") / FAN_IN).cast("int").alias("part_of")).applyInPandas(merge, schema)
    rows = level.collect()
    return list(rows[0]["piece"]) if rows else []


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``path`` is a file of the tokenizers library that exists on every machine. A null
    text counts as empty: 0 bytes, 0 tokens. An empty table gives an empty result; rows
    are neither merged nor dropped, also not if they repeat or their id is null; other
    columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    frequent = frequent_pieces(docs, path, text)
    splitter = tokens.Splitter(path)
    lengths = np.array([len(splitter.piece_ids(p)) for p in frequent], dtype=np.uint8)
    key = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast(("\x00".join(frequent).encode(), lengths.tobytes()))

    def table() -> dict:
        pieces, sizes = shared.value
        known = pieces.decode().split("\x00") if pieces else []
        return dict(zip(known, sizes, strict=True))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = tokens.splitter(path)
        known = tokens.piece_cache(path, len, key, table)
        for batch, texts in text_batches(batches, text):
            found = []
            for value in texts:
                pieces = split.split(value)
                found.append(len(split.ids(value)) if pieces is None else sum(map(known.__getitem__, pieces)))
            sizes = [len(value.encode()) for value in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias(text)).mapInArrow(
        count, f"id {kind}, n_bytes bigint, n_tokens bigint"
    )
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
