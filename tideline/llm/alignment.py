"""Aligns the tokens of two tokenizers by the bytes they cover, and counts which ids meet.

A byte-level BPE file (A) and a sentencepiece model (B) cut the same bytes. The ends of A's
and B's tokens are two sorted lists; merging them gives every overlap. The merge is parted
by merge path: a binary search on each diagonal of the merge grid finds where a piece of
equal work begins, so that pieces need nothing of each other, whatever the lengths of the
documents in them. Each piece gives its overlaps and the ends that both lists share; the
groups between shared ends are stitched across the borders of pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import text_batches, written

#: Steps of the merge in one piece.
PIECE_STEPS = 1 << 16
#: Pairs of ids whose counts are broadcast: the most frequent ones, at most so many.
FREQUENT_PAIRS = 1 << 18
#: Pieces of text each of a worker's three caches keeps per generation.
KEPT = 250_000
#: A pair of ids as one number: A's above B's.
ID_BITS = 20

_SPACE = "▁"
#: Stretches of a text that begins with white space; all but the first begin with a blank or newline behind other than white space.
_CHUNK = re.compile(r"\s+\S*(?:[^\S \n]\s*\S*)*")
#: Marks ids of B where they stand among those of A, and, alone, a chunk whose tokens do not have its bytes.
_OF_B, _WRONG = 1 << 31, b"\xff" * 4


class _Kept(dict):
    """Ids of pieces of text as bytes, in two generations; long pieces are not kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.old: dict = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = tokens.id_bytes(self.encode(piece))
        if len(piece) <= tokens.KEPT_LENGTH:
            if len(self) >= KEPT:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


class ByteLevel:
    """Ids by a byte-level file of the tokenizers library; special strings are plain text."""

    def __init__(self, path: str):
        self.splitter = tokens.Splitter(path)
        self.splitter.special = []
        self.splitter.tokenizer.encode_special_tokens = True
        self.kept = _Kept(self.splitter.piece_ids)
        byte = {chr(letter): b for b, letter in tokens._byte_letters().items()}
        size = self.splitter.tokenizer.get_vocab_size()
        names = [self.splitter.tokenizer.id_to_token(i) or "" for i in range(size)]
        # The special token's own name is never met; it is decoded like the others.
        self.bytes = [bytes(byte[c] for c in name if c in byte) for name in names]

    def ids(self, text: str) -> bytes:
        pieces = self.splitter.split(text)
        if pieces is None:
            return tokens.id_bytes(self.splitter.ids(text))
        return b"".join(map(self.kept.__getitem__, pieces))


class Pieces:
    """Ids by a sentencepiece model that puts a space before the text.

    Where no piece of the model holds a space mark behind another character, or a newline
    at all, no merge reaches over the start of a run of spaces or over a newline: the
    stretches between are encoded on their own and kept. Other models take whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(_SPACE, " ").encode()
            for i, name in enumerate(names)
        ]
        parts = not any(re.search(rf"[^{_SPACE}]{_SPACE}|\n", name) for name in names)
        # Only a model that leaves texts as they are may be fed in parts.
        probe = "a  b\n\tÁ ﬁ c "
        same = model.normalize(probe) == _SPACE + probe.replace(" ", _SPACE)
        self.part = re.compile(r" +[^ \n]*|\n[^ \n]*") if parts and same else None
        self.space = [names.index(_SPACE)] if _SPACE in names else []
        self.kept = _Kept(self._part_ids)

    def _part_ids(self, part: str) -> list[int]:
        if part == " ":
            return self.space
        # The model's own space stands for the first one of the part, or before the newline.
        ids = self.model.encode(part.removeprefix(" "), num_threads=1)
        return ids[1:] if part[0] == "\n" else ids

    def ids(self, text: str) -> bytes:
        if self.part is None or _SPACE in text:
            return tokens.id_bytes(self.model.encode(text, num_threads=1))
        return b"".join(map(self.kept.__getitem__, self.part.findall(" " + text)))


def _joined_equal(table: list[bytes], ids: np.ndarray, raw: bytes) -> bool:
    return b"".join(map(table.__getitem__, ids.tolist())) == raw


class Both:
    """Ids of texts by both tokenizers, where the tokens' bytes are those of a space and the text.

    No token and no merge of either reaches over the start of a chunk: neither a pre-token
    of A nor a part of B goes on there. So chunks are encoded and compared with their bytes
    on their own and kept, one look-up for both; what one run of texts meets anew is encoded
    by B at once. Texts that either library has to cut itself go to them whole.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = a, b = ByteLevel(a_path), Pieces(b_path)
        if max(len(a.bytes), len(b.bytes)) > 1 << ID_BITS:
            raise ValueError(f"ids above {ID_BITS} bits")
        self.a_length, self.b_length = (np.fromiter(map(len, t.bytes), np.int64, len(t.bytes)) for t in (a, b))
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _chunks(self, text: str) -> list[str] | None:
        if self.b.part is None or _SPACE in text or self.a.splitter.unsafe_text(text):
            return None
        return _CHUNK.findall(" " + text)

    def _alone(self, chunk: str) -> bytes:
        """A's ids of a chunk, and B's with a mark."""
        raw = chunk.encode()
        x, y = (
            np.frombuffer(b"".join(map(kept.__getitem__, pattern.findall(chunk))), "<u4")
            for kept, pattern in ((self.a.kept, self.a.splitter.piece), (self.b.kept, self.b.part))
        )
        fine = _joined_equal(self.a.bytes, x, raw) and _joined_equal(self.b.bytes, y, raw)
        return x.tobytes() + (y | np.uint32(_OF_B)).tobytes() if fine else _WRONG

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        """:meth:`_alone` of each chunk; joined in one text, if its tokens have the text's bytes and end where chunks do."""
        # Behind white space the next chunk would not begin a pre-token and a part.
        joint = [c for c in chunks if not c[-1].isspace()]
        out = {}
        if joint:
            joined = "".join(joint)
            raw, ends = joined.encode(), np.cumsum([len(c.encode()) for c in joint])
            x = np.frombuffer(b"".join(map(self.a.kept.__getitem__, self.a.splitter.piece.findall(joined))), "<u4")
            # The model's own space stands for the first blank, or before the newline.
            y = np.array(self.b.model.encode(joined.removeprefix(" "), num_threads=1), "<u4")[int(joined[0] == "\n") :]
            places, fine = [], True
            for table, length, ids in ((self.a.bytes, self.a_length, x), (self.b.bytes, self.b_length, y)):
                stops = np.cumsum(length[ids])
                at = np.searchsorted(stops, ends)
                fine = fine and _joined_equal(table, ids, raw) and bool((stops[at] == ends).all())
                places.append(np.append(0, 4 * (at + 1)).tolist())
            if fine:
                x, y = x.tobytes(), (y | np.uint32(_OF_B)).tobytes()
                (a_cut, b_cut) = places
                out = {c: x[i:j] + y[k:n] for c, i, j, k, n in zip(joint, a_cut, a_cut[1:], b_cut, b_cut[1:], strict=False)}
        return out | {c: self._alone(c) for c in chunks if c not in out}

    def _whole(self, text: str) -> bytes:
        """The ids of a text as a whole; none, if its tokens have other bytes."""
        raw = f" {text}".encode()
        x, y = np.frombuffer(self.a.ids(" " + text), "<u4"), np.frombuffer(self.b.ids(text), "<u4")
        fine = _joined_equal(self.a.bytes, x, raw) and _joined_equal(self.b.bytes, y, raw)
        return x.tobytes() + (y | np.uint32(_OF_B)).tobytes() if fine else b""

    def ids(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """How many ids of A and of B each text has, and the ids of A and of B of all."""
        cut = [self._chunks(t) if t else [] for t in texts]
        chunks = [c for each in cut if each for c in each]
        found = list(map(self.kept.get, chunks))
        missed = [i for i, ids in enumerate(found) if ids is None]
        if missed:
            # In the order they are met, so that reruns agree on what is kept.
            new = dict.fromkeys([chunks[i] for i in missed])
            new.update({c: ids for c in new if (ids := self.old.get(c)) is not None})
            new.update(self._encode([c for c, ids in new.items() if ids is None]))
            for i in missed:
                found[i] = new[chunks[i]]
            if len(self.kept) >= KEPT:
                self.old, self.kept = self.kept, {}
            self.kept.update((c, ids) for c, ids in new.items() if len(c) <= tokens.KEPT_LENGTH)
        rows, at = [], 0
        for text, each in zip(texts, cut, strict=True):
            if each is None:
                rows.append(self._whole(text))
            else:
                rows.append(b"".join(found[at : at + len(each)]))
                at += len(each)
        marked = np.frombuffer(b"".join(rows), "<u4")
        if (marked == 0xFFFFFFFF).any():
            wrong = [(np.frombuffer(row, "<u4") == 0xFFFFFFFF).any() for row in rows]
            rows = [self._whole(t) if is_wrong else row for t, row, is_wrong in zip(texts, rows, wrong, strict=True)]
            marked = np.frombuffer(b"".join(rows), "<u4")
        of_b = marked >= _OF_B
        ends = np.cumsum([len(row) // 4 for row in rows])
        n_b = np.diff(np.append(0, np.cumsum(of_b))[ends], prepend=0)
        n_a = np.diff(ends, prepend=0) - n_b
        return n_a, n_b, marked[~of_b].astype(np.int64), (marked[of_b] & np.uint32(_OF_B - 1)).astype(np.int64)


_WORKER: dict = {}


def _pair(a_path: str, b_path: str) -> Both:
    """This worker's tokenizers."""
    key = (a_path, b_path)
    if key not in _WORKER:
        tokens.forget()
        _WORKER.clear()
        _WORKER[key] = Both(a_path, b_path)
    return _WORKER[key]


def diagonal(a_end: np.ndarray, b_end: np.ndarray, steps: int) -> tuple[int, int]:
    """How many of ``a_end`` and of ``b_end`` are the first ``steps`` of both merged; equal ends are never parted.

    Where a diagonal would part two equal ends, both belong to the piece before it.
    """
    low, high = max(0, steps - len(b_end)), min(steps, len(a_end))
    while low < high:
        i = (low + high) // 2
        # A's end i comes among the first steps if it is not above the B end it competes with.
        if a_end[i] <= b_end[steps - i - 1]:
            low = i + 1
        else:
            high = i
    i, j = low, steps - low
    if i and j < len(b_end) and b_end[j] == a_end[i - 1]:
        j += 1
    return i, j


def piece_overlaps(a_end: np.ndarray, b_end: np.ndarray, begin: tuple[int, int], end: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """Overlaps of one piece as places in A and B, and the last places in A and B of the groups that end in it.

    Between two neighbours among all ends lies one overlap: of the first A token and the
    first B token that end there or later, in the piece or just behind it.
    """
    a, b = a_end[begin[0] : end[0]], b_end[begin[1] : end[1]]
    # Two sorted runs: a stable sort merges them.
    ends = np.sort(np.concatenate([a, b]), kind="stable")
    last = np.append(ends[1:] != ends[:-1], True)[: len(ends)]
    shared, ends = ends[~last], ends[last]
    found = (np.searchsorted(x, y) for y in (ends, shared) for x in (a, b))
    return tuple(at + first for at, first in zip(found, begin * 2, strict=True))


def merge_pieces(a_end: np.ndarray, b_end: np.ndarray, steps: int = PIECE_STEPS) -> tuple[np.ndarray, ...]:
    """:func:`piece_overlaps` of all pieces, stitched: a group open at the end of a piece is closed by a later one."""
    total = len(a_end) + len(b_end)
    cuts = [diagonal(a_end, b_end, at) for at in range(0, total, steps)] + [(len(a_end), len(b_end))]
    found = [piece_overlaps(a_end, b_end, x, y) for x, y in zip(cuts, cuts[1:], strict=False)]
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _digits() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Small numbers as eight letters in a word: decimal digits set to the right, then a comma; which letters count, and how many."""
    number = np.arange(1 << 17)[:, None]
    power = 10 ** np.arange(7)[::-1]
    shown = np.pad((number >= power) | (power == 1), ((0, 0), (0, 1)), constant_values=True)
    letters = np.pad((number // power % 10 + 48).astype(np.uint8), ((0, 0), (0, 1)), constant_values=ord(","))
    return letters.view(np.uint64)[:, 0], shown.view(np.uint64)[:, 0], shown.sum(axis=1)


def group_texts(a_id: np.ndarray, b_id: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, closes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups as ``a1,a2|b1;a3|b2,b3``, and where each group's text ends.

    ``a_last`` and ``b_last`` are the last places of the groups; where ``closes`` holds, a
    document ends with the group and no semicolon follows.
    """
    if not len(a_last):
        return b"", np.zeros(0, np.int64)
    if "digits" not in _WORKER_TABLES:
        _WORKER_TABLES["digits"] = _digits()
    letters, shown, size = _WORKER_TABLES["digits"]
    if max(a_id.max(), b_id.max()) >= len(letters):
        raise ValueError("ids above the table of digits")
    # Group of each token; a group's A tokens stand before its B tokens.
    a_size, b_size = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
    a_at = np.arange(len(a_id)) + np.repeat(b_last + 1 - b_size, a_size)
    b_at = np.arange(len(b_id)) + np.repeat(a_last + 1, b_size)
    ids = np.empty(len(a_id) + len(b_id), np.int64)
    ids[a_at], ids[b_at] = a_id, b_id
    cells, keep, sizes = letters[ids].view(np.uint8), shown[ids].view(bool), size[ids]
    cells[8 * a_at[a_last] + 7] = ord("|")
    cells[8 * b_at[b_last] + 7] = ord(";")
    closing = b_at[b_last[closes]]
    keep[8 * closing + 7] = False
    sizes[closing] -= 1
    return cells[keep].tobytes(), np.cumsum(sizes)[b_at[b_last]]


_WORKER_TABLES: dict = {}

_ALIGNED = (
    "id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<int>"
)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``row``, the counts of its tokens, groups and links, ``groups_sha256``, and
    its distinct linked id pairs (A's id times 2^20 plus B's) with the number of links each has; written once.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _pair(a_path, b_path)
        for batch, texts in text_batches(batches, "text"):
            n_a, n_b, a_id, b_id = both.ids(texts)
            # Both lists cover the same bytes of every document, so each document's last ends are shared.
            a_at, b_at, a_last, b_last = merge_pieces(np.cumsum(both.a_length[a_id]), np.cumsum(both.b_length[b_id]))
            doc = np.repeat(np.arange(len(texts)), n_a)
            group_doc = doc[a_last]
            n_groups = np.bincount(group_doc, minlength=len(texts))
            rendered, ends = group_texts(a_id, b_id, a_last, b_last, np.append(group_doc[1:] != group_doc[:-1], len(group_doc) > 0)[: len(group_doc)])
            stops = np.concatenate([[0], ends])[np.cumsum(n_groups)]
            sums, at = [], 0
            for stop in stops.tolist():
                sums.append(hashlib.sha256(rendered[at:stop]).hexdigest() if stop > at else "")
                at = stop
            # Documents of a run number at most 512: they fit above the pair.
            link_doc = doc[a_at]
            pairs, times = np.unique(link_doc << 2 * ID_BITS | a_id[a_at] << ID_BITS | b_id[b_at], return_counts=True)
            sizes = np.bincount(pairs >> 2 * ID_BITS, minlength=len(texts))
            columns = [
                batch.column(0), batch.column(1), pa.array(n_a), pa.array(n_b), pa.array(n_groups),
                pa.array(np.bincount(link_doc, minlength=len(texts))), pa.array(sums, pa.string()),
                _lists(pairs & ((1 << 2 * ID_BITS) - 1), sizes, pa.int64()), _lists(times, sizes, pa.int32()),
            ]
            names = "id row n_a n_b n_groups n_links groups_sha256 pairs times".split()
            yield pa.RecordBatch.from_arrays(columns, names)

    # The row number lasts, as the rows are written with it.
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    return written(rows.mapInArrow(align, _ALIGNED), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(``pair``, ``n_docs``): how many rows of :func:`aligned` hold each pair of ids linked."""
    return rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs above the least power of two that leaves at most ``most`` of them, sorted, and their counts."""
    level = F.length(F.bin("n_docs"))
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in levels:
        total += row["n"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = counts.filter(level >= least).toArrow().sort_by("pair")
    return found["pair"].to_numpy(), found["n_docs"].to_numpy()


_SHARES = "row bigint, pair bigint, times int, best bigint, n_best bigint, count_sum bigint"


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text", frequent: int = FREQUENT_PAIRS
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A encodes a space and the text, B the text, to which it adds the space. Byte offsets at
    which tokens of both end cut the tokens into groups; every pair of an A and a B token
    that share a byte is a link. The count of a pair of ids is the number of rows that hold
    it linked; ``count_sum`` adds the counts of all links, ``n_best`` is the number of links
    whose count is the highest of their A id, ties included. ``groups_sha256`` is that of
    the groups written as ``a1,a2|b1;a3|b2,b3``. Rows whose text is null or empty, or whose
    joined token bytes differ from a space and the text, have no tokens: zeros and an empty
    ``groups_sha256``. Null ids, repeated ids and repeated rows are rows of their own; an
    empty table gives an empty result. Other columns are ignored.

    Counts of the ``frequent`` most frequent pairs and each A id's highest count (one per
    id of the vocabulary) are broadcast; the other pairs join their counts, and as none of
    them is frequent, no task gets a hot key.
    """
    spark = docs.sparkSession
    rows = aligned(docs, a_path, b_path, id_col, text)
    counts = written(pair_counts(rows), "pair-counts")
    tops = counts.groupBy(F.shiftright("pair", ID_BITS).alias("a")).agg(F.max("n_docs").alias("n")).toArrow()
    best_of = np.zeros(1 << ID_BITS, np.int64)
    best_of[tops["a"].to_numpy()] = tops["n"].to_numpy()
    best_of = best_of[: int(tops["a"].to_numpy().max(initial=0)) + 1]
    known = spark.sparkContext.broadcast((*_frequent(counts, frequent), best_of))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent_pair, frequent_count, best_of = known.value
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            pair, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(frequent_pair, pair)
            hit = np.zeros(len(pair), bool)
            if len(frequent_pair):
                at = np.minimum(at, len(frequent_pair) - 1)
                hit = frequent_pair[at] == pair
            count = frequent_count[at[hit]]
            best = best_of[pair >> ID_BITS]
            n_best, count_sum = np.zeros((2, len(sizes)), np.int64)
            np.add.at(n_best, doc[hit], np.where(count == best[hit], times[hit], 0))
            np.add.at(count_sum, doc[hit], count * times[hit])
            row = batch.column(0).to_numpy()
            miss = ~hit
            none = np.zeros(miss.sum(), np.int64)
            # What is known of each row, under a number no pair has, and its pairs that are not.
            yield pa.RecordBatch.from_pydict(
                {
                    "row": np.concatenate([row, row[doc[miss]]]),
                    "pair": np.concatenate([-1 - row, pair[miss]]),
                    "times": np.concatenate([np.zeros(len(row), np.int32), times[miss].astype(np.int32)]),
                    "best": np.concatenate([np.zeros(len(row), np.int64), best[miss]]),
                    "n_best": np.concatenate([n_best, none]),
                    "count_sum": np.concatenate([count_sum, none]),
                }
            )

    parts = rows.select("row", "pairs", "times").mapInArrow(shares, _SHARES)
    joined = parts.join(counts, "pair", "left")
    n = F.coalesce("n_docs", F.lit(0))
    sums = joined.groupBy("row").agg(
        F.sum(F.col("n_best") + F.when(n == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("count_sum") + n * F.col("times")).alias("count_sum"),
    )
    out = rows.select("id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row")
    return out.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
