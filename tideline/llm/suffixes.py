"""Removes long passages that an earlier document holds, by prefix doubling over sampled suffixes.

Every suffix is named by its prefix, and names double: of 1, 2, 4, 8, 16, then 25 and at
last 50 bytes (the threshold), each from two names of the step before at a growing offset.
Up to 25 bytes a name needs its own block's text only. Of the suffixes, those are kept
whose 25-byte name is the least within some 50-byte window: equal windows choose equal
suffixes, so one suffix in about 13 stands for all. Spark sorts the names of all blocks, in
two rounds:

1. 25-byte name and name of the stretch of windows the suffix stands for (50 to 75 bytes).
   A stretch that an earlier block holds as a whole is settled, and so is one whose 25-byte
   name is followed and preceded by the same bytes everywhere.
2. What is left, the edges of repeats, is sent window by window, named by its 50 bytes, and sorted
   again: past the threshold, the earliest document of each window is all that counts.

Names only find what may be equal; bytes decide, within a block as they are and between
blocks as digests of 128 bits, or as they are if asked for. A stretch whose name occurs more
than once is sent with its digest along with round 2, and where different ones meet under one
name, round 2 is run again with all windows of that name.

Blocks are ranges of the ids, cut from rows that Spark has range-sorted, so "in an earlier
document" is "in an earlier block, or before in the same one", and a name needs no id with
it. A block's names are sent without repeats: a passage in a third of all documents is one
name per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import written

LENGTH = 50
HALF = LENGTH // 2
#: Bytes of text in a block, which one task holds at a time, and in the part of it that is worked on at once.
BLOCK_BYTES = 3 << 19
STRIDE = 1 << 17
#: Bytes of text whose names make a part of the sort.
PART_BYTES = 8 << 20
#: Bytes a document counts in its block beside its text.
ROW_BYTES = 16
#: Round 2 sends windows with their bytes, so its parts are smaller by this factor.
FINER = 4
#: Longest stretch, and the 64-bit words that hold a window, or a stretch with its number of windows and its name.
WIDEST = LENGTH + HALF
_WINDOW_WORDS, _STRETCH_WORDS = 7, 11
#: Odd multipliers of the two halves of a digest.
_DIGEST = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)
#: Rows whose bytes are compared at once.
_COMPARED = 1 << 15
_U = np.uint64
# Odd multipliers of the steps, and random values of the bytes.
_STEPS = ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9), (8, 0x27D4EB2F165667C5))
_TO_HALF, _TO_FULL = 0xD6E8FEB86659FD93, 0x9FB21C651E98DF25
_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256).astype(np.uint64) * _U(2) + _U(1)
#: Bits of a sent name: of the 25-byte name within its part, and of the stretch.
_STRETCH_BITS = 36
_EMIT = "round int, part int, block bigint, names binary"
_REPLY = "block bigint, round int, part int, status binary, clash boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _double(name: np.ndarray, offset: int, factor: int) -> np.ndarray:
    """Names of longer prefixes: each name paired with the one at ``offset``."""
    left = name[:-offset] >> _U(29)
    left ^= name[:-offset]
    left *= _U(factor)
    left += name[offset:]
    return left


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _parts(names: np.ndarray, parts: int) -> np.ndarray:
    """Part of each name, ascending with the names."""
    return (((names >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64)


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts by the keys (stable); the order, and the number of its distinct key for each sorted row."""
    order = np.argsort(keys[0])
    # Most names occur once: only the others need the other keys and a stable order.
    in_order = keys[0][order]
    same = np.concatenate([[False], in_order[1:] == in_order[:-1], [False]])
    tied = np.flatnonzero(same[1:] | same[:-1])
    if len(tied):
        rows = np.sort(order[tied])
        order[tied] = rows[np.lexsort([key[rows] for key in keys[::-1]])]
    new = np.zeros(len(order), np.int64)
    for key in keys:
        in_order = key[order]
        new[1:] |= in_order[1:] != in_order[:-1]
    return order, np.cumsum(new)


def _words(data: np.ndarray, low: np.ndarray, high: np.ndarray | None = None) -> np.ndarray:
    """Bytes of the windows at ``low``, or of the stretches from ``low`` to ``high`` with their extent, as rows of 64-bit words."""
    width = LENGTH if high is None else WIDEST
    room = 8 * (_WINDOW_WORDS if high is None else _STRETCH_WORDS - 1)
    out = np.zeros((len(low), room), np.uint8)
    if len(low):
        # Windows end inside the data, stretches may be shorter than the widest.
        if high is not None:
            data = np.concatenate([data, np.zeros(HALF, np.uint8)])
        out[:, :width] = np.lib.stride_tricks.sliding_window_view(data, width)[low]
        if high is not None:
            extent = high - low
            out[:, :width][np.arange(width) >= (extent + LENGTH)[:, None]] = 0
            out[:, width] = extent
    return out.view("<u8")


def _digest(words: np.ndarray) -> np.ndarray:
    """Rows of words as 128 bits: two chains of their own over the bytes, neither related to the names."""
    out = np.empty((len(words), 2), np.uint64)
    for i, factor in enumerate(_DIGEST):
        chain = np.full(len(words), factor, np.uint64)
        for column in words.T:
            chain = _mix((chain ^ column) * _U(factor) + (column >> _U(32 * i + 1)))
        out[:, i] = chain
    return out


def _exact_firsts(words, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_firsts` by the keys, and by the bytes as well if rows of equal keys differ in them; ``words`` gives the rows' bytes."""
    order, number = _firsts(*keys)
    new = np.diff(number, prepend=-1) > 0
    first, again = order[new], np.flatnonzero(~new)
    for at in range(0, len(again), _COMPARED):
        some = again[at : at + _COMPARED]
        if (words(order[some]) != words(first[number[some]])).any():
            return _firsts(*keys, *words(np.arange(len(order))).T)
    return order, number


class Block:
    """The documents of a range of ids: which of their windows occur earlier, as far as replies tell."""

    def __init__(self, rows: list[tuple[int, bytes]], parts: int, name_bits: int, whole: bool):
        self.parts, self.whole = parts, whole
        self.mask = _U((1 << 64) - (1 << (64 - name_bits)))
        self.data = np.frombuffer(b"".join(text for _, text in rows), np.uint8)
        sizes = np.array([len(text) for _, text in rows], np.int64)
        self.ends = np.cumsum(sizes)
        ids = np.array([doc_id for doc_id, _ in rows], np.int64)
        rank = np.zeros(len(rows), np.int64)
        rank[1:] = np.cumsum(ids[1:] != ids[:-1])
        low, high, half, stretch, full = [], [], [], [], []
        for at in range(0, max(0, len(self.data) - LENGTH + 1), STRIDE):
            part = self._stretches(at)
            low.append(part[0])
            high.append(part[1])
            half.append(part[2])
            stretch.append(part[3])
            full.append(part[4])
        empty = [np.empty(0, np.int64)]
        self.low, self.high = np.concatenate(low or empty), np.concatenate(high or empty)
        self.rank = rank[np.searchsorted(self.ends, self.low, side="right")]
        self.half = np.concatenate(half or [np.empty(0, np.uint64)])
        self.stretch = np.concatenate(stretch or [np.empty(0, np.uint64)])
        self.full = np.concatenate(full or [np.empty(0, np.uint64)])
        self.order, self.number = _exact_firsts(
            lambda i: _words(self.data, self.low[i], self.high[i]), self.half, self.stretch
        )
        self.first = np.flatnonzero(np.diff(self.number, prepend=-1))

    def _stretches(self, at: int) -> tuple[np.ndarray, ...]:
        """Stretches of windows from ``at`` on that share their least suffix: ends and names, and the windows' own names, not yet mixed."""
        piece = self.data[at : at + STRIDE + LENGTH - 1]
        name = _BYTE[piece]
        for offset, factor in _STEPS:
            name = _double(name, offset, factor)
        half = _double(name, HALF - 16, _TO_HALF)
        full = _double(half, LENGTH - HALF, _TO_FULL)
        # The position makes equal names differ, so that the first of them is the least.
        bits = _U(STRIDE.bit_length() + 1)
        key = _mix(half)
        key >>= bits
        key <<= bits
        key |= np.arange(len(half), dtype=np.uint64)
        least = _least(key, LENGTH - HALF + 1)
        # The last windows that start in a document leave it; those of different documents share no suffix.
        inside = np.zeros(len(least) + 2, bool)
        inside[1:-1] = True
        ends = self.ends[np.searchsorted(self.ends, at, side="right") : np.searchsorted(self.ends, at + len(piece), side="left") + 1]
        out = (ends[:, None] - np.arange(1, LENGTH)).ravel() - at
        inside[out[(out >= 0) & (out < len(least))] + 1] = False
        turns = np.ones(len(least) + 1, bool)
        turns[1:-1] = least[1:] != least[:-1]
        low = np.flatnonzero(inside[1:-1] & (turns[:-1] | ~inside[:-2]))
        high = np.flatnonzero(inside[1:-1] & (turns[1:] | ~inside[2:]))
        chosen = (least[low] & ((_U(1) << bits) - _U(1))).astype(np.int64)
        before = (chosen - low).astype(np.uint64)
        extent = (high - low).astype(np.uint64)
        mixed = _mix(full[low] + before * _U(_TO_HALF)) * _U(_TO_FULL) + full[high] + extent
        names = [_mix(n) & self.mask for n in (half[chosen], mixed)]
        return low + at, high + at, names[0], names[1] >> _U(64 - _STRETCH_BITS), full

    def _sent(self, rows: np.ndarray) -> np.ndarray:
        gram = self.half[rows] & ((_U(1) << _U(64 - _STRETCH_BITS)) - _U(1))
        return (gram << _U(_STRETCH_BITS)) | self.stretch[rows]

    def stretch_names(self) -> tuple[np.ndarray, np.ndarray]:
        """Parts and names of the distinct stretches, in the order replies come in."""
        rows = self.order[self.first]
        return _parts(self.half[rows], self.parts), self._sent(rows)

    def stretch_bytes(self, status: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts, and names with bytes, of the distinct stretches whose name occurs more than once by the reply of round 1."""
        rows = self.order[self.first[(status & 4) > 0]]
        words = _words(self.data, self.low[rows], self.high[rows])
        words = np.column_stack([self._sent(rows), words if self.whole else _digest(words)])
        return _parts(self.half[rows], self.parts), words

    def settle_stretches(self, status: np.ndarray, checked: np.ndarray | None = None) -> None:
        """Takes the replies of rounds 1 and, once there, 3; finds the windows that go into round 2."""
        if checked is not None:
            # Bytes decide what is earlier, and a name of different bytes is as good as none.
            sure = np.zeros_like(status)
            sure[(status & 4) > 0] = checked
            status = (sure & 1) | (status & 2) | (sure & 2)
        status = status[self.number]
        later = self.rank[self.order] > self.rank[self.order[self.first]][self.number]
        settled = ((status & 1) > 0) | later
        self.settled = self.order[settled]
        left = self.order[~settled & ((status & 2) > 0)]
        count = self.high[left] - self.low[left] + 1
        window = np.repeat(self.low[left] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        rank = np.repeat(self.rank[left], count)
        keep = np.argsort(window, kind="stable")
        self.window, self.window_rank = window[keep], rank[keep]
        self.window_name = _mix(self.full[self.window]) & self.mask
        self.window_order, self.window_number = _exact_firsts(
            lambda i: _words(self.data, self.window[i]), self.window_name
        )
        self.window_first = np.flatnonzero(np.diff(self.window_number, prepend=-1))

    def window_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Parts and bytes of the distinct windows, in the order replies come in."""
        rows = self.window_order[self.window_first]
        words = _words(self.data, self.window[rows])
        return _parts(self.window_name[rows], FINER * self.parts), words if self.whole else _digest(words)

    def removed(self, status: np.ndarray) -> np.ndarray:
        """Takes the reply of round 2; the mask of the bytes to remove."""
        later = self.window_rank[self.window_order] > self.window_rank[self.window_order[self.window_first]][self.window_number]
        hit = self.window[self.window_order[((status & 1)[self.window_number] > 0) | later]]
        steps = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(steps, self.low[self.settled], 1)
        np.add.at(steps, self.high[self.settled] + LENGTH, -1)
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + LENGTH, -1)
        return np.cumsum(steps[:-1]) > 0


def _emission(turn: int, block: int, parts: np.ndarray, names: np.ndarray) -> pa.Table:
    cuts = np.flatnonzero(np.diff(parts, prepend=-1))
    pieces = np.split(names, cuts[1:]) if len(cuts) else []
    return pa.table(
        {"round": pa.array([turn] * len(cuts), pa.int32()), "part": pa.array(parts[cuts], pa.int32()),
         "block": pa.array([block] * len(cuts), pa.int64()), "names": pa.array([p.tobytes() for p in pieces], pa.binary())}
    )


def _gathered(table: pa.Table, words: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """A part's rows by ascending block: blocks, sizes, names (rows of ``words``), and the block of each name."""
    rows = sorted(zip(table.column("block").to_pylist(), table.column("names").to_pylist(), strict=True))
    sizes = np.array([len(n) // (8 * words) for _, n in rows], np.int64)
    names = np.frombuffer(b"".join(n for _, n in rows), "<u8").reshape(-1, words)
    return [b for b, _ in rows], sizes, names, np.repeat(np.arange(len(rows)), sizes)


def _sort_stretches(names: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Status of each name: 1 if an earlier block has it, 2 if its 25-byte name has others beside it, 4 if it occurs again."""
    names = names[:, 0]
    order, number = _firsts(names)
    first = np.flatnonzero(np.diff(number, prepend=-1))
    gram = names[order[first]] >> _U(_STRETCH_BITS)
    runs = np.cumsum(np.diff(gram, prepend=~gram[:1]) != 0) - 1
    several = np.bincount(runs)[runs] > 1
    again = np.diff(np.append(first, len(order))) > 1
    status = np.empty(len(order), np.uint8)
    earlier = block[order] > block[order[first]][number]
    status[order] = earlier | (several.astype(np.uint8) << 1)[number] | (again.astype(np.uint8) << 2)[number]
    return status


def _sort_bytes(rows: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Status of each row of words: 1 if an earlier block has the same, 2 if other rows share its first word only."""
    name = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        name = _mix(name * _U(_TO_FULL) + column)
    order, number = _exact_firsts(lambda i: rows[i], name)
    first = order[np.flatnonzero(np.diff(number, prepend=-1))]
    _, kind, kinds = np.unique(rows[first, 0], return_inverse=True, return_counts=True)
    status = np.empty(len(order), np.uint8)
    earlier = block[order] > block[first][number]
    status[order] = earlier | ((kinds[kind] > 1).astype(np.uint8) << 1)[number]
    return status


def _replies(emitted: DataFrame, whole: bool) -> DataFrame:
    """Sorts the names of each part and answers every block that sent some."""
    words = {1: 1, 2: _WINDOW_WORDS, 3: _STRETCH_WORDS} if whole else {1: 1, 2: 2, 3: 3}

    def answer(table: pa.Table) -> pa.Table:
        turn, part = table.column("round")[0].as_py(), table.column("part")[0].as_py()
        blocks, sizes, names, block = _gathered(table, words[turn])
        status = _sort_stretches(names, block) if turn == 1 else _sort_bytes(names, block)
        clash = turn == 3 and bool((status & 2).any())
        pieces = np.split(status, np.cumsum(sizes)[:-1])
        n = len(blocks)
        return pa.table(
            {"block": pa.array(blocks, pa.int64()), "round": pa.array([turn] * n, pa.int32()),
             "part": pa.array([part] * n, pa.int32()), "status": pa.array([s.tobytes() for s in pieces], pa.binary()),
             "clash": pa.array([clash] * n, pa.bool_())}
        )

    return emitted.groupBy("round", "part").applyInArrow(answer, _REPLY)


def _status(replies: pa.Table, turn: int) -> np.ndarray:
    """The status bytes of a round, in the order the block sent its names."""
    rows = zip(*(replies.column(c).to_pylist() for c in ("round", "part", "status")), strict=True)
    return np.frombuffer(b"".join(s for _, _, s in sorted(r for r in rows if r[0] == turn)), np.uint8)


def _closed(block: int, rows: list[pa.RecordBatch], columns: Sequence[str]) -> pa.RecordBatch:
    """The documents of a block as one row: their texts packed in one, the rest as lists."""
    table = pa.Table.from_batches(rows)
    data = [(t or "").encode() for t in table.column("_text").to_pylist()]
    lists = {c: table.column(c).combine_chunks() for c in columns}
    lists |= {"_size": pa.array([len(d) for d in data], pa.int64()), "_null": table.column("_text").combine_chunks().is_null()}
    packed = zstandard.ZstdCompressor(level=3).compress(b"".join(data))
    ends = pa.array([0, len(data)], pa.int32())
    lists = {c: pa.ListArray.from_arrays(ends, values) for c, values in lists.items()}
    own = {"_block": pa.array([block], pa.int64()), "_bytes": pa.array([sum(map(len, data))], pa.int64())}
    return pa.RecordBatch.from_pydict(own | {"_packed": pa.array([packed], pa.binary())} | lists)


def _opened(table: pa.Table) -> tuple[pa.Table, list[tuple[int, bytes]], np.ndarray]:
    """The rows of a packed block, its documents in order, and the order that sorts the rows."""
    tokens.forget()
    data = zstandard.ZstdDecompressor().decompress(table.column("_packed")[0].as_py())
    own = pa.table({c: table.column(c).combine_chunks().flatten() for c in table.column_names if pa.types.is_list(table.schema.field(c).type)})
    ends = np.cumsum(own.column("_size").to_numpy())
    starts = np.append(0, ends[:-1])
    rows = [(i, data[a:b]) for i, a, b in zip(own.column("_id").to_pylist(), starts, ends, strict=True)]
    order = sorted(range(len(rows)), key=rows.__getitem__)
    return own, [rows[i] for i in order], np.array(order, np.int64)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
    with_text: bool = False,
    block_bytes: int = BLOCK_BYTES,
    name_bits: int = 64,
    whole_bytes: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Texts count as UTF-8 bytes (null: empty). Every byte covered by a 50-byte string that
    also starts in a document with a smaller id is removed; strings are judged on the
    input. Rows that share an id are not earlier than each other; a row with a null id
    has no place in the order, loses nothing and takes nothing from others. An empty
    table gives an empty result. ``keep`` names columns to carry along, ``with_text`` adds
    ``kept_text``, the remaining bytes as text, without characters that were cut into
    (null for a null text). Fewer ``name_bits`` give the same result in more time.
    Between blocks, digests of 128 bits stand for bytes (two of 10^13 different stretches
    share one with a probability below 10^-12); ``whole_bytes`` sends the bytes themselves.
    """
    carried = [c for c in keep if c not in (id_col, text)]
    # Names of their own inside, whatever they are called outside.
    kept = [f"_keep{i}" for i in range(len(carried))]
    others = [F.col(f"`{c}`").alias(k) for c, k in zip(carried, kept, strict=True)]
    base = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text).alias("_text"), *others)
    placed = base.filter("_id is not null")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks whose numbers ascend with the id, within a range and from range to range; equal ids share one."""
        block, held, rows, last = TaskContext.get().partitionId() << 32, 0, [], None
        for batch in batches:
            at = 0
            sizes = batch.column(1).to_pylist()
            for i, (doc_id, size) in enumerate(zip(batch.column(0).to_pylist(), sizes, strict=True)):
                if doc_id != last and held and held + size > block_bytes:
                    if i > at:
                        rows.append(batch.slice(at, i - at))
                    yield _closed(block, rows, ["_id", *kept])
                    block, held, rows, at = block + 1, 0, [], i
                held, last = held + size + ROW_BYTES, doc_id
            if batch.num_rows > at:
                rows.append(batch.slice(at))
        if rows:
            yield _closed(block, rows, ["_id", *kept])

    types = {"_id": "bigint"} | {k: docs.schema[c].dataType.simpleString() for c, k in zip(carried, kept, strict=True)}
    types |= {"_size": "bigint", "_null": "boolean"}
    schema = "_block bigint, _bytes bigint, _packed binary" + "".join(f", {c} array<{t}>" for c, t in types.items())
    sized = placed.select("_id", F.coalesce(F.octet_length("_text"), F.lit(0)).alias("_length"), "_text", *kept)
    ranged = sized.repartitionByRange("_id").sortWithinPartitions("_id")
    packed = written(ranged.mapInArrow(cut, schema), "suffix-blocks")
    total = packed.agg(F.sum("_bytes").alias("n")).first()["n"] or 0
    parts = max(1, -(-total // PART_BYTES))

    def send_stretches(key: tuple, table: pa.Table) -> pa.Table:
        block = Block(_opened(table)[1], parts, name_bits, whole_bytes)
        return _emission(1, key[0].as_py(), *block.stretch_names())

    def send_bytes(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(_opened(table)[1], parts, name_bits, whole_bytes)
        status = _status(replies, 1)
        block.settle_stretches(status)
        sent = [_emission(2, key[0].as_py(), *block.window_bytes()), _emission(3, key[0].as_py(), *block.stretch_bytes(status))]
        return pa.concat_tables(sent)

    def send_windows(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(_opened(table)[1], parts, name_bits, whole_bytes)
        block.settle_stretches(_status(replies, 1), _status(replies, 3))
        return _emission(2, key[0].as_py(), *block.window_bytes())

    def finish(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        own, rows, order = _opened(table)
        block = Block(rows, parts, name_bits, whole_bytes)
        block.settle_stretches(_status(replies, 1), _status(replies, 3))
        mask = block.removed(_status(replies, 2))
        out: dict = {"_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        texts = []
        missing = own.column("_null").to_pylist()
        start = 0
        for i, (doc_id, value) in zip(order, rows, strict=True):
            cover = mask[start : start + len(value)]
            start += len(value)
            left = np.frombuffer(value, np.uint8)[~cover].tobytes() if cover.any() else value
            out["_id"].append(doc_id)
            out["n_bytes"].append(len(value))
            out["n_removed"].append(len(value) - len(left))
            out["n_spans"].append(int(np.count_nonzero(np.diff(cover.astype(np.int8), prepend=0) == 1)))
            out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            texts.append(None if missing[i] else left.decode(errors="ignore"))
        if with_text:
            out["kept_text"] = pa.array(texts, pa.string())
        ordered = own.take(pa.array(order))
        return pa.table(out | {c: ordered.column(c) for c in kept})

    result = "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    result += ", kept_text string" if with_text else ""
    result += "".join(f", {k} {types[k]}" for k in kept)
    grouped = packed.groupBy("_block")
    first = written(_replies(grouped.applyInArrow(send_stretches, _EMIT), whole_bytes), "stretch-replies")
    second = written(_replies(grouped.cogroup(first.groupBy("block")).applyInArrow(send_bytes, _EMIT), whole_bytes), "byte-replies")
    both = first.union(second)
    if not second.filter("clash").isEmpty():
        checked = first.union(second.filter("round = 3"))
        again = _replies(grouped.cogroup(checked.groupBy("block")).applyInArrow(send_windows, _EMIT), whole_bytes)
        both = checked.union(written(again, "window-replies"))
    found = grouped.cogroup(both.groupBy("block")).applyInArrow(finish, result)
    # Rows without an id lose nothing.
    alone = base.filter("_id is null").withColumn("_bytes", F.coalesce(F.col("_text").cast("binary"), F.lit(b"")))
    sha = F.sha2("_bytes", 256).alias("kept_sha256")
    zero = F.lit(0).cast("bigint")
    texts = [F.col("_text").alias("kept_text")] if with_text else []
    size = F.octet_length("_bytes").cast("bigint").alias("n_bytes")
    alone = alone.select("_id", size, zero.alias("n_removed"), zero.alias("n_spans"), sha, *texts, *kept)
    both = found.union(alone)
    names = {"_id": id_col} | dict(zip(kept, carried, strict=True))
    return both.select(*[F.col(c).alias(names.get(c, c)) for c in both.columns])


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with what :func:`remove_repeats` leaves of their texts; ``n_chars`` follows."""
    other = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in other]).alias("row"))
    found = remove_repeats(row, keep=["row"], with_text=True)
    columns = {c: F.col("row").getField(c) for c in other} | {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in other:
        columns["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])
