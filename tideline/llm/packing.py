"""Packs pieces of documents into sequences of bounded length by length patterns.

All sequences that hold the same lengths are one pattern. Patterns of one to three pieces
that fill a sequence exactly are enumerated; non-negative least squares fits how often
each is used to the histogram of the lengths. A length weighs as much as its tokens, so
that short pieces rather than long ones are left over or lacking. The counts are rounded,
longest pieces first; a pattern that lacks its short pieces is used without them and stays
open. What is left over is packed best-fit, longest first, into open and new sequences.
Only the histogram reaches the driver; the pieces find their place by their rank among
pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import running_totals, spread_key, text_batches, written

MAX_LENGTH = 2048
#: Finest number of length classes that patterns tell apart; longer sequences use coarser classes.
CLASSES = 2048
#: Steps of the fit over all patterns, and of the second one over those the first favours.
STEPS, LAST_STEPS = 60, 1000
#: How many patterns of one longest class the second fit takes: fewer patterns lose less to rounding.
FAVOURED = 32


def cut_pieces(docs: DataFrame, path: str, max_length: int = MAX_LENGTH, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, on demand, ``ids``.

    A document is the ids of its whole text and ``end_id``; only longer ones are cut. A
    null text is empty and makes one piece of the end id. Rows that share an id are
    documents of their own.
    """
    end = tokens.id_bytes([end_id])
    step = 4 * max_length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            out: dict = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
            for doc_id, value in zip(batch.column(0).to_pylist(), texts, strict=True):
                raw = tokens.encoded(path, value) + end
                for piece, at in enumerate(range(0, len(raw), step)):
                    part = raw[at : at + step]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(memoryview(part).cast("I").tolist())
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.schema(fields + ([("ids", pa.list_(pa.int64()))] if with_ids else []))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, schema)


def full_patterns(present: np.ndarray, size: int) -> np.ndarray:
    """All patterns of up to three of the present classes that sum to ``size``: rows of descending classes, 0 for none."""
    ok = np.zeros(size + 1, bool)
    ok[present] = True
    ok[0] = True
    rows = []
    for a in range(size, 0, -1):
        if not ok[a]:
            continue
        rest = size - a
        b = np.arange(min(a, rest), (rest + 1) // 2 - 1, -1)
        b = b[ok[b] & ok[rest - b]]
        rows.append(np.stack([np.full(len(b), a), b, rest - b], axis=1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int) -> np.ndarray:
    """Non-negative least squares: how often to use each pattern so that the lengths used come nearest the histogram.

    Errors weigh by length. Accelerated projected gradient; each pattern touches at most
    three classes, so a step costs three gathers and three scatters. Class 0 stands for no
    piece and weighs nothing.
    """
    size = len(histogram)
    weight = np.arange(size) / max(size - 1, 1)
    weights = weight[patterns]

    def lengths(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns.ravel(), weights=(x[:, None] * weights).ravel(), minlength=size)

    def gradient(error: np.ndarray) -> np.ndarray:
        return (error[patterns] * weights).sum(axis=1)

    # Largest eigenvalue by power iteration: the step size.
    x = np.ones(len(patterns))
    largest = 1.0
    for _ in range(20):
        x = gradient(lengths(x))
        largest = np.linalg.norm(x)
        x /= largest
    wanted = histogram * weight
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(steps):
        new = np.maximum(0, y - gradient(lengths(y) - wanted) / (1.05 * largest))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / s * (new - x)
        x, t = new, s
    return x


def favoured(patterns: np.ndarray, fitted: np.ndarray) -> np.ndarray:
    """Of each longest class the patterns used most, in their order."""
    order = np.lexsort((-fitted, -patterns[:, 0]))
    start = np.searchsorted(-patterns[order, 0], -patterns[order, 0])
    kept = order[(np.arange(len(order)) - start < FAVOURED) & (fitted[order] > 0)]
    return patterns[np.sort(kept)]


def whole_counts(patterns: np.ndarray, fitted: np.ndarray, classes: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of classes with rounded counts that ``classes`` can serve, longest pieces first.

    Rounding carries its error on to the next pattern of the same longest class. Where the
    shortest pieces have run out the pattern is used with the two longest.
    """
    left = classes.copy()
    plan = []
    longest = patterns[:, 0]
    wanted = np.zeros(len(patterns), np.int64)
    starts = np.flatnonzero(np.diff(longest, prepend=-1))
    for first, end in zip(starts, np.append(starts[1:], len(patterns)), strict=True):
        wanted[first:end] = np.diff(np.floor(np.cumsum(fitted[first:end]) + 0.5), prepend=0)
    for k in np.flatnonzero(wanted):
        pattern = tuple(int(c) for c in patterns[k] if c)
        n = int(wanted[k])
        for part in (pattern, pattern[:2]):
            times = min(n, *(int(left[c]) // part.count(c) for c in set(part)))
            if times:
                for c in part:
                    left[c] -= times
                plan.append((part, times))
                n -= times
    return plan


def pack_histogram(histogram: np.ndarray, max_length: int = MAX_LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with repeat counts that use up ``histogram`` (index: length) exactly."""
    left = histogram.astype(np.int64).copy()
    grain = -(-max_length // CLASSES)
    size = max_length // grain
    plan: list[tuple[tuple[int, ...], int]] = []
    if grain == 1:
        classes = left
    else:
        # Classes round up, so a pattern of classes never overflows with lengths below them.
        classes = np.bincount(np.minimum(-(-np.arange(len(left)) // grain), size), weights=left, minlength=size + 1).astype(np.int64)
    patterns = full_patterns(np.flatnonzero(classes), size)
    if len(patterns):
        patterns = favoured(patterns, fit_counts(patterns, classes.astype(float), STEPS))
        fitted = fit_counts(patterns, classes.astype(float), LAST_STEPS)
        for pattern, times in whole_counts(patterns, fitted, classes):
            plan += _use(pattern, times, left, grain)
    return best_fit(left, max_length, plan)


def _use(classes: tuple[int, ...], wanted: int, left: np.ndarray, grain: int) -> list[tuple[tuple[int, ...], int]]:
    """Uses a pattern of classes up to ``wanted`` times while its lengths are left; takes them from ``left``."""
    made = []
    while wanted:
        pattern = []
        for c in classes:
            low = (c - 1) * grain + 1
            span = left[low : c * grain + 1]
            free = [int(low + i) for i in np.flatnonzero(span)[::-1] if span[i] > pattern.count(low + i)]
            if not free:
                return made
            pattern.append(free[0])
        times = min(wanted, *(int(left[n]) // pattern.count(n) for n in set(pattern)))
        for n in pattern:
            left[n] -= times
        made.append((tuple(pattern), times))
        wanted -= times
    return made


def best_fit(left: np.ndarray, max_length: int, plan: list[tuple[tuple[int, ...], int]] = ()) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram, into the sequences of ``plan`` and new ones: equal sequences are moved together."""
    open_by_space: dict[int, list[list]] = {}
    spaces = 0  # bit s is set while a sequence with s free places is open
    for pattern, times in plan:
        space = max_length - sum(pattern)
        open_by_space.setdefault(space, []).append([pattern, times])
        spaces |= 1 << space
    for length in np.flatnonzero(left)[::-1]:
        n, length = int(left[length]), int(length)
        while n:
            above = spaces >> length
            if above:
                space = length + (above & -above).bit_length() - 1
                group = open_by_space[space][-1]
                times = min(n, group[1])
                pattern = (*group[0], length)
                group[1] -= times
                if not group[1]:
                    open_by_space[space].pop()
                    if not open_by_space[space]:
                        spaces &= ~(1 << space)
            else:
                per = max_length // length
                pattern, times = ((length,) * per, n // per) if n >= per else ((length,) * n, 1)
                space = max_length
            space = max_length - sum(pattern) if not above else space - length
            open_by_space.setdefault(space, []).append([pattern, times])
            spaces |= 1 << space
            n -= times * (1 if above else len(pattern))
    return [(pattern, n) for groups in open_by_space.values() for pattern, n in groups]


def _slots(plan: list[tuple[tuple[int, ...], int]], max_length: int) -> tuple[np.ndarray, ...]:
    """For each length its slots, one behind the other: first rank, first sequence and offset of a run of equal slots."""
    length, sequence, offset, times = [], [], [], []
    base = 0
    for pattern, n in plan:
        at = 0
        for piece in pattern:
            length.append(piece)
            sequence.append(base)
            offset.append(at)
            times.append(n)
            at += piece
        base += n
    columns = [np.array(c, np.int64) for c in (length, sequence, offset, times)]
    order = np.argsort(columns[0], kind="stable")
    length, sequence, offset, times = (c[order] for c in columns)
    start = np.cumsum(times) - times
    first = np.searchsorted(length, np.arange(max_length + 2))
    rank = start - start[first[length]] if len(length) else start
    return first, rank, sequence, offset


def place_pieces(pieces: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """``pieces`` (``doc_id``, ``piece``, ``length``, ...) with ``sequence_id`` and ``offset``.

    Pieces of one length take its slots in an order spread by a hash of document and
    piece; a length that holds a third of all pieces is ranked bucket by bucket. The
    slots are sent to every task: there are at most as many runs of them as patterns of
    three lengths and steps of the best fit, whatever the number of pieces.
    """
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = np.zeros(max_length + 1, np.int64)
    for row in rows:
        histogram[row["length"]] = row["n"]
    shared = pieces.sparkSession.sparkContext.broadcast(_slots(pack_histogram(histogram, max_length), max_length))
    columns = pieces.columns
    ranked = pieces.withColumn("_key", spread_key("doc_id", "piece")).withColumn("_one", F.lit(1))
    ties = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in columns]
    ranked = running_totals(ranked, ["length"], "_key", ties, "_one", int(histogram.sum())).drop("_key", "_one")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, rank, sequence, offset = shared.value
        for batch in batches:
            length = batch.column(columns.index("length")).to_numpy()
            wanted = batch.column(len(columns)).to_numpy()
            # Runs are sorted by (length, rank); ranks stay below the number of pieces.
            top = int(max(rank.max(initial=0), wanted.max(initial=0))) + 1
            of = np.repeat(np.arange(len(first) - 1), np.diff(first))
            run = np.searchsorted(of * top + rank, length * top + wanted, side="right") - 1
            added = [pa.array(sequence[run] + wanted - rank[run]), pa.array(offset[run])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "before").mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, max_length: int = MAX_LENGTH, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: see :func:`cut_pieces` and :func:`place_pieces`.

    An empty table gives an empty result. Other columns of ``docs`` are ignored.
    """
    return place_pieces(written(cut_pieces(docs, path, max_length, end_id, with_ids), "pieces"), max_length)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences of :func:`pack_documents` with ids: ``sequence_id``, ``doc_ids`` and ``ids``, in order of offset."""
    packed = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = placed.groupBy("sequence_id").agg(packed.alias("p"))
    return rows.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.flatten("p.ids").alias("ids"))
