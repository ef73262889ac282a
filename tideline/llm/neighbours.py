"""Approximate nearest neighbours by inner product: NN-descent builds the graph, greedy search queries it.

The graph starts from blocks of vectors that random hyperplanes do not part, and from blocks
dealt at random, whose links lead from one patch to another. Each round of NN-descent joins every vector with its neighbours and those it is a neighbour of: they are
neighbours of neighbours, and pairs of them that beat what they have replace it. A query
walks the graph from its entries and from the longest vectors: it opens the best vectors it
knows, scores their neighbours, keeps the best, and so on. Links are the largest inner
products, as the answers are; leaves of the trees go by direction alone, so that no vector's
length moves the others. Equal vectors are one node of the graph.

Nodes are dealt to blocks, a row each, and named by block and place. Blocks of nodes and of
queries send each other arrays; no row of a table stands for a link, a node met or a score,
and a block fetches a vector once for all that need it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

DEGREE = 40
#: Neighbours in either direction that meet at a node in one round.
MEETING = 64
#: Rounds end when fewer links than this share are new, and after the last at the latest.
STILL, ROUNDS = 0.01, 12
#: Trees whose leaves give the first links, and as many deals of all vectors at random: leaves alone leave patches.
TREES, DEALS = 3, 3
LEAF = 2048
#: Links a leaf's vectors start with.
FIRST_LINKS = 24
#: Vectors the hyperplanes are laid through (the bound of the sample, drawn by a hash of the id).
SAMPLE = 20_000
#: Vectors a query remembers and those it opens in a round; rounds go on while there are any, up to the last.
BEAM, OPENED, STEPS = 400, 64, 24
#: The longest vectors, which every query is scored against, as they have the largest products with most.
LONGEST = 512
NODES_PER_BLOCK = 512
#: Vectors that a block of nodes, or of queries, meets in one step, in bytes at most; one query is a block at least.
BLOCK_BYTES = 64 << 20
#: A node is named by its block, and its place there in so many bits.
SHIFT = 16
_MESSAGE = "to bigint, kind int, src bigint, a binary, b binary, c binary, d binary"
_MESSAGE_ARROW = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("src", pa.int64()), *((c, pa.binary()) for c in "abcd")])
#: What messages hold. Of nodes: double vectors and ids; codes and leaves; links; links found; links back; who meets; worst links; codes asked for and sent.
_VECTOR, _CODE, _LINKS, _FOUND, _BACK, _MET, _LEAST, _ASK, _ANSWER = range(9)
#: Of queries: names, codes, vectors and limits; what is known; all ever met; nodes to open; met at first; links of opened ones; to be scored; scores.
_QUERY, _KNOWN, _SEEN, _OPEN, _FIRST, _LINKED, _SCORE, _SCORED = range(9, 17)


def usable(vectors: DataFrame) -> DataFrame:
    """(``vec_id``, ``vec``): rows that take part. Null, zero and non-finite vectors and null ids do not, nor do vectors of other than the commonest length."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    rows = rows.filter(~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))
    size = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows if size is None else rows.filter(F.size("vec") == size["size"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a column of equally long byte strings, none null, as a matrix of floats."""
    parts = [c for c in column.chunks if len(c)]
    if not parts:
        return np.zeros((0, 0), np.float32)
    rows = []
    for part in parts:
        ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1]
        rows.append(np.frombuffer(part.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float32).reshape(len(part), -1))
    return rows[0] if len(rows) == 1 else np.concatenate(rows)


def _codes(vec: np.ndarray, longest: float) -> np.ndarray:
    """Vectors as floats, those of norm ``longest`` of length 1; a few far longer ones, which all queries meet, are cut to 1e18."""
    size = np.abs(vec).max(axis=1, keepdims=True)
    toward = vec / size
    norm = np.sqrt((toward * toward).sum(axis=1, keepdims=True))
    with np.errstate(over="ignore"):
        times = np.minimum(size / longest * norm, 1e18)
    return (toward / norm * times).astype(np.float32)


def _directions(vec: np.ndarray) -> np.ndarray:
    """Vectors of length 1; through their largest component first, so that no square is lost."""
    vec = vec / np.abs(vec).max(axis=1, keepdims=True)
    return (vec / np.sqrt((vec * vec).sum(axis=1, keepdims=True))).astype(np.float32)


def _norm(vec: str) -> Column:
    """Euclidean length; through the largest component, so that no square is lost or infinite."""
    largest = F.array_max(F.transform(vec, F.abs))
    return F.get(
        F.transform(F.array(largest), lambda m: m * F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + (x / m) * (x / m)))), 0
    )


def _planes(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree of hyperplanes: directions and medians of the sample on them, node 1 at the root."""
    rng = np.random.default_rng(seed)
    direction = rng.standard_normal((1 << depth, sample.shape[1])).astype(np.float32)
    middle = np.zeros(1 << depth, np.float32)
    node = np.ones(len(sample), np.int64)
    for _ in range(depth):
        side = np.einsum("ij,ij->i", sample, direction[node])
        for k in np.unique(node):
            middle[k] = np.median(side[node == k])
        node = 2 * node + (side > middle[node])
    return direction, middle


def _leaf(vec: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    node = np.ones(len(vec), np.int64)
    for _ in range(depth):
        node = 2 * node + (np.einsum("ij,ij->i", vec, tree[0][node]) > tree[1][node])
    return node


class Index:
    """A graph over the vectors; see :func:`build`."""

    def __init__(self, vectors: DataFrame, coded: DataFrame, members: DataFrame, links: DataFrame, n: int, dim: int, blocks: int, longest: float, leaf: Callable, entries: np.ndarray):
        self.vectors, self.coded, self.members, self.links = vectors, coded, members, links
        self.n, self.dim, self.blocks = n, dim, blocks
        self.longest, self.leaf, self.entries = longest, leaf, entries

    def places(self) -> DataFrame:
        """(``id``, ``gid``): the name of every node."""

        def name(batches):
            for batch in batches:
                for m in _received(pa.Table.from_batches([batch]))[_VECTOR]:
                    ids = _array(m[2], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((m[5] << SHIFT) + np.arange(len(ids)))], ["id", "gid"])

        return self.vectors.mapInArrow(name, "id bigint, gid bigint")


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a column of equally long lists of numbers, none null, as a matrix."""
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks if len(c)]
    return np.concatenate(parts).reshape(len(column), -1)


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    """The vectors of a block, by ascending id."""
    ids = table.column("id").to_numpy()
    if len(ids) > 1 << SHIFT:
        raise ValueError(f"{len(ids)} nodes in one block")
    order = np.argsort(ids)
    return _send([(key[0].as_py(), _VECTOR, key[0].as_py(), _numbers(table.column("vec")).astype(float, copy=False)[order], ids[order])])


def build(vectors: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, seed: int = 1) -> Index | None:
    """Indexes every usable row of ``vectors`` (``vec_id``, ``embedding``); None if there is none.

    Hyperplanes are laid through a bounded sample. The leaves are counted, and each that came
    out larger than twice :data:`LEAF` is dealt to as many parts as it needs by a hash, so no
    task's leaf grows with the data, also where no plane parts near copies.
    """
    rows = usable(vectors)
    # Equal vectors are one node, named by the smallest id.
    named = rows.groupBy("vec").agg(F.min("vec_id").alias("id"))
    nodes = written(named, "nn-nodes")
    members = rows.join(nodes, "vec").select("vec_id", "id")
    n = nodes.count()
    if not n:
        return None
    # The scale is that of the longest vector but LONGEST, so that a few of any length do not wipe out the others.
    norms = nodes.select("id", _norm("vec").alias("norm")).orderBy(F.desc("norm"), "id")
    longest = (norms.offset(LONGEST).first() or norms.first())["norm"]
    share = min(1.0, SAMPLE / n)
    drawn = nodes.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).select("vec").limit(2 * SAMPLE)
    sample = _directions(_numbers(drawn.toArrow().column("vec")).astype(float, copy=False))
    dim = sample.shape[1]
    depth = max(0, min(math.ceil(math.log2(max(n / LEAF, 1))), int(math.log2(len(sample)))))
    trees = [_planes(sample, depth, seed + t) for t in range(TREES)]
    shared = vectors.sparkSession.sparkContext.broadcast(trees)
    # Larger blocks fetch less, but what a node's block fetches has to fit into a task's memory.
    per = max(1, min(max(NODES_PER_BLOCK, 8 * math.isqrt(n)), BLOCK_BYTES // (MEETING * 4 * dim), 1 << (SHIFT - 2)))
    blocks = math.ceil(n / per)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
    packed = written(nodes.select("id", "vec").repartition(blocks, block).groupBy(block).applyInArrow(_packed, _MESSAGE), "nn-vectors")

    def encode(kind: int, message: tuple) -> list[tuple]:
        vec = _array(message[1], float).reshape(-1, dim)
        toward = _directions(vec)
        leaves = np.stack([_leaf(toward, tree, depth) for tree in shared.value] + [np.zeros(len(vec), np.int64)] * DEALS, axis=1)
        return [(message[5], _CODE, message[5], _codes(vec, longest), leaves)]

    coded = written(_each(packed, encode), "nn-codes")

    def laid_out(batches):
        for batch in batches:
            for m in _received(pa.Table.from_batches([batch]))[_CODE]:
                code = _array(m[1], np.float32).reshape(-1, dim)
                leaves = _array(m[2], np.int64).reshape(len(code), -1)
                ids = pa.array((m[5] << SHIFT) + np.arange(len(code)))
                texts = pa.array([c.tobytes() for c in code], pa.binary())
                for tree in range(leaves.shape[1]):
                    yield pa.RecordBatch.from_arrays([ids, texts, pa.array(np.full(len(code), tree, np.int32)), pa.array(leaves[:, tree])], ["id", "code", "tree", "leaf"])

    def link(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)
        ids, code = ids[order], _matrix(table.column("code"))[order]
        k = min(FIRST_LINKS, len(ids) - 1)
        dst, score = np.empty((len(ids), k), np.int64), np.empty((len(ids), k), np.float32)
        for at in range(0, len(ids) if k else 0, 512):
            similar = code[at : at + 512] @ code.T
            similar[np.arange(len(similar)), np.arange(at, at + len(similar))] = -np.inf
            best = np.argpartition(similar, len(ids) - k, axis=1)[:, len(ids) - k :]
            dst[at : at + 512], score[at : at + 512] = ids[best], np.take_along_axis(similar, best, axis=1)
        sender = key[0].as_py() << 40 | len(ids)
        return _send([(to, _FOUND, sender, np.repeat(_places(ids[at]), k), dst[at], score[at]) for to, at in _parts(ids)])

    exploded = _dealt(coded.mapInArrow(laid_out, "id bigint, code binary, tree int, leaf bigint"))
    coded = coded.withColumn("b", F.lit(None).cast("binary"))
    links = _merged(exploded.groupBy("tree", "leaf", "deal").applyInArrow(link, _MESSAGE), degree, blocks)
    for turn in range(rounds):
        links = _descend(links, coded, dim, degree, turn, blocks)
        if (links.agg(F.sum("src")).first()[0] or 0) <= STILL * n * min(degree, n - 1):
            break
    index = Index(packed, coded, members, links, n, dim, blocks, longest, lambda vec: _leaf(_directions(vec), trees[0], depth), np.empty(0, np.int64))
    # The longest vectors, a bounded number, are met by every query.
    known = index.places().join(F.broadcast(norms.limit(LONGEST).select("id")), "id").select("gid").toArrow()
    index.entries = np.sort(known["gid"].to_numpy())
    return index


def _dealt(exploded: DataFrame) -> DataFrame:
    """Adds ``deal``: the part of its leaf that a row (``id``, ``tree``, ``leaf``) goes to, each leaf in as many as it needs."""
    sizes = exploded.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).alias("parts"))
    return exploded.join(sizes, ["tree", "leaf"]).withColumn("deal", F.pmod(F.xxhash64("id", "tree"), "parts")).drop("parts")


def _send(rows: list[tuple]) -> pa.Table:
    """Messages (``to``, ``kind``, ``src``, and up to four arrays) as a table."""
    columns: list[list] = [[], [], [], [], [], [], []]
    for to, kind, src, *arrays in rows:
        for column, value in zip(columns, (to, kind, src), strict=False):
            column.append(int(value))
        for i in range(4):
            columns[3 + i].append(arrays[i].tobytes() if i < len(arrays) and arrays[i] is not None else None)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _MESSAGE_ARROW.types, strict=True)], schema=_MESSAGE_ARROW)


def _array(buffer: pa.Buffer | None, kind: type) -> np.ndarray:
    if buffer is None or not buffer.size:
        return np.empty(0, kind)
    values = np.frombuffer(buffer, kind)
    return values if values.flags.aligned else values.copy()


def _cells(column: pa.ChunkedArray) -> list[pa.Buffer | None]:
    """The bytes of each row of a column, not copied."""
    out: list[pa.Buffer | None] = []
    for chunk in column.chunks:
        _, ends, data = chunk.buffers()
        ends = np.frombuffer(ends, np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].tolist() if len(chunk) else []
        out += [data.slice(a, b - a) if b > a else None for a, b in zip(ends, ends[1:], strict=False)]
    return out


def _received(table: pa.Table) -> dict[int, list[tuple]]:
    """Messages by kind, in the order of their senders: (``src``, ``a``, ``b``, ``c``, ``d``, ``to``)."""
    kinds, src, to = (table.column(c).to_numpy() for c in ("kind", "src", "to"))
    cells = [_cells(table.column(c)) for c in "abcd"]
    out: dict[int, list[tuple]] = {}
    for i in np.lexsort((src, kinds)).tolist():
        out.setdefault(int(kinds[i]), []).append((int(src[i]), *(c[i] for c in cells), int(to[i])))
    return out


def _joined(messages: list[tuple], kinds: str) -> list[np.ndarray]:
    """The arrays of several messages end to end; ``kinds`` has a type for each."""
    return [np.concatenate([_array(m[1 + i], np.dtype(k)) for m in messages] or [np.empty(0, k)]) for i, k in enumerate(kinds.split())]


def _step(messages: DataFrame, act: Callable[[int, dict[int, list[tuple]]], list[tuple]], parts: int) -> DataFrame:
    """Each block gets what was sent to it, and sends messages of its own."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return _send(act(key[0].as_py(), _received(table)))

    return messages.repartition(parts, "to").groupBy("to").applyInArrow(run, _MESSAGE)


def _each(messages: DataFrame, act: Callable[[int, tuple], list[tuple]]) -> DataFrame:
    """As :func:`_step`, for messages that are worked on one by one, where they are."""

    def run(batches):
        for batch in batches:
            for kind, found in _received(pa.Table.from_batches([batch])).items():
                for message in found:
                    yield from _send(act(kind, message)).to_batches()

    return messages.mapInArrow(run, _MESSAGE)


def _tasks(blocks: int) -> int:
    """Tasks for blocks of queries, which differ in size: some in each, where there are many."""
    return max(1, min(blocks, max(12, blocks // 4)))


def _of(messages: DataFrame, *kinds: int) -> DataFrame:
    return messages.filter(F.col("kind").isin(*kinds))


def _parts(gids: np.ndarray) -> list[tuple[int, slice]]:
    """The blocks of ascending nodes, and where each is."""
    block = gids >> SHIFT
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    return [(int(block[a]), slice(a, b)) for a, b in zip(cuts, np.append(cuts[1:], len(gids)), strict=False)]


def _places(gids: np.ndarray) -> np.ndarray:
    return (gids & ((1 << SHIFT) - 1)).astype(np.uint16)


def _falling(score: np.ndarray) -> np.ndarray:
    """Whole numbers of 32 bits that rise as the scores fall."""
    bits = (score + np.float32(0)).view(np.int32).astype(np.int64)
    return 0x7FFFFFFF - np.where(bits < 0, bits ^ 0x7FFFFFFF, bits)


def _rank(group: np.ndarray) -> np.ndarray:
    """The place of each row in its group, from 0; rows of a group stand together."""
    at = np.arange(len(group))
    first = np.zeros(len(group), np.int64)
    starts = np.flatnonzero(group[1:] != group[:-1]) + 1
    first[starts] = starts
    return at - np.maximum.accumulate(first)


def _top(src: np.ndarray, dst: np.ndarray, score: np.ndarray, new: np.ndarray, degree: int, bits: int = 47) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the ``degree`` best links of each source, each link once, and whether it is new (not, if it was there before).

    Targets have ``bits`` bits, sources the rest of 63.
    """
    if not len(src):
        return np.empty(0, np.int64), np.empty(0, np.uint8)
    key = (src.astype(np.int64) << bits) | dst
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    new = np.minimum.reduceat(new[order], starts)
    order = order[starts]
    best = np.argsort((src[order].astype(np.int64) << 32) | _falling(score[order]), kind="stable")
    best = best[_rank(src[order[best]]) < degree]
    return order[best], new[best]


def _drawn(meeting: np.ndarray, met: np.ndarray, turn: int) -> np.ndarray:
    """16 random bits for a node, one that it meets, and the round."""
    mixed = (meeting.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (met.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(turn * 0x165667B1))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) & np.uint64(0xFFFF)


def _merged(messages: DataFrame, degree: int, parts: int) -> DataFrame:
    """The best links of every node, written: a message of each block to itself, which names the number of new ones."""

    def merge(block: int, got: dict) -> list[tuple]:
        kept, found = _joined(got.get(_LINKS, []), "u2 i8 f4"), _joined(got.get(_FOUND, []), "u2 i8 f4")
        place, dst, score = (np.concatenate(x) for x in zip(kept, found, strict=True))
        new = np.repeat(np.array([0, 1], np.uint8), [len(kept[0]), len(found[0])])
        best, new = _top(place, dst, score, new, degree)
        return [(block, _LINKS, new.sum(), place[best], dst[best], score[best], new)]

    return written(_step(messages, merge, parts), "nn-edges")


def _meetings(place: np.ndarray, met: np.ndarray, new: np.ndarray, block: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all that a block's nodes may meet, :data:`MEETING` for each, new ones first: number of each node with a new one, nodes met, and whether new."""
    key = (place.astype(np.int64) << 47) | met
    order = np.argsort(key)
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    # A neighbour in both directions stands twice.
    new = np.maximum.reduceat(new[order], starts) if len(order) else new
    place, met = place[order[starts]].astype(np.int64), met[order[starts]]
    drawn = _drawn((block << SHIFT) | place, met, turn).astype(np.int64)
    order = np.argsort((place << 17) | ((1 - new.astype(np.int64)) << 16) | drawn, kind="stable")
    order = order[_rank(place[order]) < MEETING]
    order = order[np.isin(place[order], place[order][new[order] > 0])]
    return np.unique(place[order], return_counts=True)[1].astype(np.int32), met[order], new[order]


def _tried(count: np.ndarray, met: np.ndarray, new: np.ndarray, names: np.ndarray, code: np.ndarray, least: np.ndarray, degree: int) -> list[tuple]:
    """Nodes that meet try each other; what beats a node's worst link is sent to it."""
    code = np.concatenate([code, np.zeros((1, code.shape[1]), np.float32)])
    least = np.append(least, np.float32(np.inf))
    ends = np.cumsum(count)
    width = int(count.max(initial=1))
    who = np.full((len(count), width), len(names))
    fresh = np.zeros(who.shape, bool)
    row = np.repeat(np.arange(len(count)), count)
    column = np.arange(len(met)) - np.repeat(ends - count, count)
    who[row, column], fresh[row, column] = np.searchsorted(names, met), new > 0
    best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)]
    some: list[list[np.ndarray]] = [[], [], []]
    per = max(1, (1 << 24) // (width * (width + code.shape[1]) * 4))
    held = 0
    for at in range(0, len(who), per):
        own, new_one = who[at : at + per], fresh[at : at + per]
        near = code[own]
        similar = np.matmul(near, near.transpose(0, 2, 1))
        better = similar > least[own][:, :, None]
        better &= new_one[:, :, None] | new_one[:, None, :]
        better &= (own < len(names))[:, None, :]
        better[:, np.arange(width), np.arange(width)] = False
        hit = np.flatnonzero(better)
        i, j = hit // width, hit // (width * width) * width + hit % width
        for column, values in zip(some, (own.ravel()[i], own.ravel()[j], similar.ravel()[hit]), strict=True):
            column.append(values)
        held += len(hit)
        if held > 1 << 21 or at + per >= len(who):
            best = [np.concatenate([x, *y]) for x, y in zip(best, some, strict=True)]
            order, _ = _top(best[0], best[1], best[2], np.ones(len(best[0]), np.uint8), degree, 31)
            best, some, held = [x[order] for x in best], [[], [], []], 0
    v, w = names[best[0]], names[best[1]]
    return [(block, _FOUND, 0, _places(v[at]), w[at], best[2][at]) for block, at in _parts(v)]


def _descend(links: DataFrame, coded: DataFrame, dim: int, degree: int, turn: int, parts: int) -> DataFrame:
    """One round: neighbours of a node, in both directions, meet at it and try each other.

    Blocks of nodes tell each other their links, fetch every vector they need once, and
    send what they find; all that moves are arrays from block to block.
    """

    def tell(kind: int, message: tuple) -> list[tuple]:
        place, dst, new = _array(message[1], np.uint16), _array(message[2], np.int64), _array(message[4], np.uint8)
        block = message[5]
        own = (block << SHIFT) | place.astype(np.int64)
        # No more than can meet leave a block, however many point at a node.
        key = (dst.astype(np.uint64) << np.uint64(17)) | ((1 - new).astype(np.uint64) << np.uint64(16)) | _drawn(dst, own, turn)
        order = np.argsort(key, kind="stable")
        order = order[_rank(dst[order]) < MEETING]
        told = dst[order]
        return [(to, _BACK, block, _places(told[at]), own[order[at]], None, new[order[at]]) for to, at in _parts(told)]

    def ask(block: int, got: dict) -> list[tuple]:
        place, dst, score, new = _joined(got.get(_LINKS, []), "u2 i8 f4 u1")
        back = got.get(_BACK, [])
        count, met, fresh = _meetings(
            np.concatenate([place, *(_array(m[1], np.uint16) for m in back)]),
            np.concatenate([dst, *(_array(m[2], np.int64) for m in back)]),
            np.concatenate([new, *(_array(m[4], np.uint8) for m in back)]),
            block,
            turn,
        )
        full, at, links = np.unique(place, return_index=True, return_counts=True)
        least = np.minimum.reduceat(score, at) if len(at) else score
        wanted = np.unique(met)
        out = [(block, _LEAST, block, full[links >= degree], least[links >= degree]), (block, _MET, block, count, met, fresh)]
        return out + [(to, _ASK, block, _places(wanted[at])) for to, at in _parts(wanted)]

    def answer(block: int, got: dict) -> list[tuple]:
        out = [(block, _MET, block, *(_array(x, np.uint8) for x in m[1:4])) for m in got.get(_MET, [])]
        if asked := got.get(_ASK):
            code = _array(got[_CODE][0][1], np.float32).reshape(-1, dim)
            least = np.full(len(code), -np.inf, np.float32)
            for m in got.get(_LEAST, []):
                least[_array(m[1], np.uint16)] = _array(m[2], np.float32)
            for m in asked:
                place = _array(m[1], np.uint16)
                out.append((m[0], _ANSWER, block, place, code[place], least[place]))
        return out

    def meet(block: int, got: dict) -> list[tuple]:
        count, met, new = _joined(got.get(_MET, []), "i4 i8 u1")
        if not len(met):
            return []
        answers = got[_ANSWER]
        names = np.concatenate([(m[0] << SHIFT) | _array(m[1], np.uint16).astype(np.int64) for m in answers])
        code = np.concatenate([_array(m[2], np.float32) for m in answers]).reshape(-1, dim)
        return _tried(count, met, new, names, code, np.concatenate([_array(m[3], np.float32) for m in answers]), degree)

    told = links.union(_each(links, tell))
    asked = _step(told, ask, parts).union(coded)
    found = _step(_step(asked, answer, parts), meet, parts)
    return _merged(links.union(found), degree, parts)


def _linked(index: Index) -> DataFrame:
    """The links of every node in both directions, written; :data:`DEGREE` of those that point at it, the best."""

    def tell(kind: int, message: tuple) -> list[tuple]:
        place, dst, score = _array(message[1], np.uint16), _array(message[2], np.int64), _array(message[3], np.float32)
        order = np.lexsort((place, -score, dst))
        order = order[_rank(dst[order]) < DEGREE]
        told = dst[order]
        own = (message[5] << SHIFT) | place[order].astype(np.int64)
        return [(to, _BACK, message[5], _places(told[at]), own[at], score[order[at]]) for to, at in _parts(told)]

    def both(block: int, got: dict) -> list[tuple]:
        place, dst, _ = _joined(got.get(_LINKS, []), "u2 i8 f4")
        to, back, score = _joined(got.get(_BACK, []), "u2 i8 f4")
        order = np.lexsort((back, -score, to))
        order = order[_rank(to[order]) < DEGREE]
        key = (np.append(place, to[order]).astype(np.int64) << 47) | np.append(dst, back[order])
        key = np.unique(key)
        return [(block, _LINKS, block, (key >> 47).astype(np.uint16), key & ((1 << 47) - 1))]

    return written(_step(index.links.union(_each(index.links, tell)), both, index.blocks), "nn-links")


def search(index: Index, queries: DataFrame, beam: int = BEAM, opened: int = OPENED, steps: int = STEPS) -> DataFrame:
    """What the walk of every query (``query_id``, ``vec``, ``entry``: a node's name) ends with: messages of blocks of queries.

    Queries are walked in blocks that enter near each other: what their walks meet is
    scored for all of the block, once, where the vectors are. A block has as many queries
    as keep what a step can meet below :data:`BLOCK_BYTES`.
    """
    dim, node_blocks, longest, leaf, entries = index.dim, index.blocks, index.longest, index.leaf, index.entries
    per_block = max(1, BLOCK_BYTES // (opened * 2 * DEGREE * 4 * max(1, dim)))

    def home(batches):
        for batch in batches:
            if batch.num_rows:
                vec = _numbers(pa.chunked_array([batch.column(1)])).astype(float, copy=False)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf(vec))], ["query_id", "vec", "entry", "home"])

    asked = queries.select("query_id", "vec", "entry").mapInArrow(home, "query_id bigint, vec array<double>, entry bigint, home bigint")
    # Queries of one leaf share blocks: its blocks are as many as its queries need.
    sizes = asked.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / per_block).alias("deals"))
    deal = F.pmod(F.xxhash64("query_id"), F.col("deals"))
    # Blocks of queries have names below 0.
    to = -1 - F.pmod(F.xxhash64("home", deal), F.lit((1 << 62) - 1))

    def start(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        order = np.argsort(table.column("query_id").to_numpy())
        names, entry = table.column("query_id").to_numpy()[order], np.unique(table.column("entry").to_numpy())
        vec = _numbers(table.column("vec")).astype(float, copy=False)[order]
        limit = np.full(len(names), -np.inf, np.float32)
        out = [(block, _QUERY, len(names), names, _codes(vec, longest), vec, limit), (block, _FIRST, block, np.union1d(entry, entries))]
        return _send([*out, *((to, _OPEN, block, _places(entry[at])) for to, at in _parts(entry))])

    blocks = asked.join(sizes, "home").select(to.alias("block"), "query_id", "vec", "entry").groupBy("block")
    walked = written(blocks.applyInArrow(start, _MESSAGE), "nn-queries")
    links, coded = _linked(index), index.coded
    parts = _tasks(_of(walked, _QUERY).count())

    def expand(block: int, got: dict) -> list[tuple]:
        if _OPEN not in got:
            return []
        place, dst = _joined(got.get(_LINKS, []), "u2 i8")
        out = []
        for m in got[_OPEN]:
            wanted = _array(m[1], np.uint16)
            first, last = np.searchsorted(place, wanted), np.searchsorted(place, wanted, "right")
            size = last - first
            at = np.arange(size.sum()) + np.repeat(last - np.cumsum(size), size)
            out.append((m[0], _LINKED, block, np.unique(dst[at])))
        return out

    def ask(block: int, got: dict) -> list[tuple]:
        if _LINKED not in got and _FIRST not in got:
            return []
        met = np.unique(np.concatenate(_joined(got.get(_LINKED, []), "i8") + _joined(got.get(_FIRST, []), "i8")))
        # A bit for each place of each block: what the block of queries has met before is in its beams, or too far for them.
        seen = np.zeros((node_blocks, (1 << SHIFT) // 8), np.uint8)
        kept = got.get(_SEEN)
        if kept:
            width = kept[0][0]
            seen[:, :width] = _array(kept[0][1], np.uint8).reshape(-1, width)
        row, byte, bit = met >> SHIFT, (met & ((1 << SHIFT) - 1)) >> 3, (met & 7).astype(np.uint8)
        other = (seen[row, byte] >> bit) & 1 == 0
        np.bitwise_or.at(seen, (row, byte), np.uint8(1) << bit)
        width = max(kept[0][0] if kept else 1, int(byte.max(initial=0)) + 1)
        met = met[other]
        query = got[_QUERY][0]
        code, limit = _array(query[2], np.uint8), _array(query[4], np.uint8)
        out = [(block, _SEEN, width, np.ascontiguousarray(seen[:, :width]))]
        return out + [(to, _SCORE, block, code, _places(met[at]), limit) for to, at in _parts(met)]

    def score(block: int, got: dict) -> list[tuple]:
        out = [(block, _SEEN, m[0], _array(m[1], np.uint8)) for m in got.get(_SEEN, [])]
        if _SCORE not in got:
            return out
        vectors = _array(got[_CODE][0][1], np.float32).reshape(-1, dim)
        for m in got[_SCORE]:
            code, place, limit = _array(m[1], np.float32).reshape(-1, dim), _array(m[2], np.uint16), _array(m[3], np.float32)
            similar = code @ vectors[place].T
            better = similar > limit[:, None]
            if np.count_nonzero(better, axis=1).max() > beam + 1:
                # Only what can get into a beam.
                least = np.partition(similar, similar.shape[1] - beam - 1, axis=1)[:, similar.shape[1] - beam - 1]
                better &= similar >= least[:, None]
            who, which = np.nonzero(better)
            out.append((m[0], _SCORED, block, who.astype(np.uint16), place[which], similar[who, which]))
        return out

    def choose(block: int, got: dict) -> list[tuple]:
        if _QUERY not in got:
            return []
        query = got[_QUERY][0]
        n = query[0]
        who, ids, value, done = _joined(got.get(_KNOWN, []), "u2 i8 f4 u1")
        answers = got.get(_SCORED, [])
        new_who, new_place, new_value = _joined(answers, "u2 u2 f4")
        sender = np.repeat(np.array([m[0] for m in answers], np.int64), [len(_array(m[1], np.uint16)) for m in answers])
        who = np.append(who, new_who).astype(np.int64)
        ids = np.append(ids, (sender << SHIFT) | new_place.astype(np.int64))
        value, done = np.append(value, new_value), np.append(done, np.zeros(len(new_who), np.uint8))
        order = np.lexsort((ids, -value, who))
        order = order[_rank(who[order]) < beam]
        who, ids, value, done = who[order], ids[order], value[order], done[order].copy()
        left = np.flatnonzero(done == 0)
        going = left[_rank(who[left]) < opened]
        done[going] = 1
        limit = np.full(n, -np.inf, np.float32)
        held = np.bincount(who, minlength=n)
        limit[held >= beam] = value[np.cumsum(held)[held >= beam] - 1]
        nodes = np.unique(ids[going])
        out = [(block, _QUERY, n, *(_array(x, np.uint8) for x in query[1:4]), limit), (block, _KNOWN, len(going), who.astype(np.uint16), ids, value, done)]
        out += [(block, _SEEN, m[0], _array(m[1], np.uint8)) for m in got.get(_SEEN, [])]
        return out + [(to, _OPEN, block, _places(nodes[at])) for to, at in _parts(nodes)]

    for _ in range(steps):
        met = _step(_of(walked, _OPEN).union(links), expand, node_blocks)
        asking = _step(met.union(_of(walked, _QUERY, _SEEN, _FIRST)), ask, parts)
        scored = _step(asking.union(coded), score, node_blocks)
        walked = written(_step(scored.union(_of(walked, _QUERY, _KNOWN)), choose, parts), "nn-walk")
        if not _of(walked, _KNOWN).agg(F.sum("src")).first()[0]:
            break
    return _of(walked, _QUERY, _KNOWN)


def _exact(index: Index, walked: DataFrame, most: int) -> DataFrame:
    """The ``most`` nodes of largest inner product of all that a query's walk remembers: ``query_id``, ``id``, ``score``, in double precision.

    A product is summed up component by component, as a fold over the arrays would.
    """
    dim = index.dim
    parts = _tasks(_of(walked, _QUERY).count())

    def ask(block: int, got: dict) -> list[tuple]:
        query = got[_QUERY][0]
        vec = _array(query[3], float).reshape(-1, dim)
        who, ids, _, _ = _joined(got.get(_KNOWN, []), "u2 i8 f4 u1")
        order = np.lexsort((who, ids))
        who, ids = who[order], ids[order]
        out = []
        for to, at in _parts(ids):
            own, at_own = np.unique(who[at], return_inverse=True)
            out.append((to, _SCORE, block, own, at_own.astype(np.uint16), _places(ids[at]), vec[own]))
        return [*out, (block, _QUERY, query[0], _array(query[1], np.uint8))]

    def score(block: int, got: dict) -> list[tuple]:
        out = [(block, _QUERY, m[0], _array(m[1], np.uint8)) for m in got.get(_QUERY, [])]
        if _SCORE not in got:
            return out
        own = got[_VECTOR][0]
        vectors, ids = _array(own[1], float).reshape(-1, dim).T.copy(), _array(own[2], np.int64)
        for m in got[_SCORE]:
            who, at, place = (_array(x, np.uint16) for x in m[1:4])
            asked = _array(m[4], float).reshape(-1, dim).T
            total = np.zeros(len(place))
            with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                for x, y in zip(vectors[:, place], asked[:, at], strict=True):
                    total += x * y
            out.append((m[0], _SCORED, block, who[at], ids[place], total))
        return out

    def pick(key: tuple, table: pa.Table) -> pa.Table:
        got = _received(table)
        names = _array(got[_QUERY][0][1], np.int64)
        who, ids, value = _joined(got.get(_SCORED, []), "u2 i8 f8")
        order = np.lexsort((ids, -value, ~np.isnan(value), who))
        order = order[_rank(who[order]) < most]
        return pa.table({"query_id": names[who[order]], "id": ids[order], "score": value[order]})

    asked = _step(walked, ask, parts)
    scored = _step(asked.union(index.vectors), score, index.blocks)
    return scored.filter("to < 0").repartition(parts, "to").groupBy("to").applyInArrow(pick, "query_id bigint, id bigint, score double")


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """The ``k`` nearest other rows of each row of ``vectors`` for which ``queries`` holds.

    Columns: ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the inner product
    in double precision on the original vectors; ties go to the smaller ``vec_id``. All
    candidates if there are fewer than ``k``. Rows that :func:`usable` leaves out are
    neither query nor candidate; equal vectors are all found, by ascending id; rows that
    share an id are expected to be equal. Products too small for a double are 0 and tie;
    of those that tie, the ones found count. Other columns are ignored. Without usable
    rows the result is empty.
    """
    index = build(vectors)
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    entry = usable(vectors).filter(queries).join(index.members, "vec_id").select(F.col("vec_id").alias("query_id"), "vec", "id").distinct()
    entry = entry.join(index.places(), "id").select("query_id", "vec", F.col("gid").alias("entry"))
    # All that a walk remembers are scored exactly, by node, as equal vectors score alike.
    # A node more than asked for: the query's own may hold no other row.
    exact = _exact(index, search(index, entry, max(BEAM, 2 * k)), k + 1)
    # A node gives its smallest ids: k and the query's own are enough.
    place = F.row_number().over(Window.partitionBy("id").orderBy("vec_id"))
    copies = index.members.distinct().withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")
    scored = exact.join(copies, "id").filter("query_id <> vec_id").select("query_id", "vec_id", "score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
