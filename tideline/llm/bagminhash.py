"""Near-duplicates by weighted Jaccard similarity of word shingles: BagMinHash, bands, exact check.

A text is a bag of shingles of five words. Unit steps of a shingle's count are grouped in
doubling ranges; each (shingle, range) is a Poisson process whose points carry a random
component of the signature and a random step of the range. Points of steps the count does
not reach are passed over; a component keeps its earliest point. Two signatures agree in a
component with the probability of the bags' weighted Jaccard similarity. The signature is
cut into bands; texts with an equal band are candidates, and their bags are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import text_batches, written
from .components import components

SHINGLE = 5
BANDS = 32
ROWS = 6
COMPONENTS = BANDS * ROWS
#: Similarity of at least 4/5, in whole numbers.
SIMILAR = (4, 5)
#: Rounds that compare a bucket's members with one of them before the rest is compared in blocks.
STAR_ROUNDS = 2
BLOCK = 512
#: Runs hold at most 512 texts: the low bits of a shingle's hash make room for the text's number.
_ROW_BITS = 10
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str) -> np.ndarray:
    """Hashes of a text's shingles, with repeats: one per word that starts five; one in all for one to four words."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, SHINGLE)
    found = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        found = _mix(found * _U(0x9E3779B97F4A7C15) + word[k : k + len(found)])
    return found >> _U(_ROW_BITS)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(text), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> bool:
    """Whether two bags have a weighted Jaccard similarity of :data:`SIMILAR` or more."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    # common / (total - common) >= p / q
    return common * (SIMILAR[0] + SIMILAR[1]) >= SIMILAR[0] * total and common > 0


def signatures(bags: list[np.ndarray]) -> np.ndarray:
    """Signatures (earliest points) of at most 512 bags of shingles, each not empty: a row per bag."""
    sizes = np.array([len(b) for b in bags], np.int64)
    rows = np.repeat(np.arange(len(bags), dtype=np.uint64), sizes)
    keys, counts = np.unique((np.concatenate(bags) << _U(_ROW_BITS)) | rows, return_counts=True)
    row = (keys & _U((1 << _ROW_BITS) - 1)).astype(np.int64)
    seed = _mix(keys >> _U(_ROW_BITS))
    # One process per range of steps that a count reaches: [0, 1), [1, 2), [2, 4), [4, 8), ...
    ranges = [(np.arange(len(keys)), 0)]
    k = 1
    while (reached := np.flatnonzero(counts > 1 << (k - 1))).size:
        ranges.append((reached, k))
        k += 1
    of = np.concatenate([r for r, _ in ranges])
    level = np.concatenate([np.full(len(r), k, np.int64) for r, k in ranges])
    first = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.where(level > 0, 1 << np.maximum(level - 1, 0), 1)
    process = _mix(seed[of] + level.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    row, weight = row[of], counts[of]
    result = np.full((len(bags), COMPONENTS), np.inf)
    # All components of a bag have a point before this bound, but for one bag in twenty, which gets a later one.
    bound = (np.log(COMPONENTS) + 3) / sizes
    todo = np.ones(len(bags), bool)
    while todo.any():
        at = np.flatnonzero(todo[row])
        _points(result, at, process, row, weight, first, width, bound)
        todo = np.isinf(result).any(axis=1)
        bound = bound * 2
    return result


def _points(result, at, process, row, weight, first, width, bound) -> None:
    """Draws the points of the processes ``at`` up to their bags' bounds and keeps each component's earliest."""
    last = np.zeros(len(at))
    drawn, block = 0, 4
    flat = result.reshape(-1)
    while len(at):
        steps = _U(2) * np.arange(drawn, drawn + block, dtype=np.uint64)
        bits = _mix(process[at][:, None] + steps * _U(0x9E3779B97F4A7C15))
        gap = -np.log(((bits >> _U(11)).astype(float) + 0.5) / (1 << 53)) / (COMPONENTS * width[at])[:, None]
        gap[:, 0] += last
        time = np.cumsum(gap, axis=1)
        inside = time <= bound[row[at]][:, None]
        i, j = np.nonzero(inside)
        other = _mix(bits[i, j] + _U(0x165667B19E3779F9))
        component = ((other >> _U(32)) % _U(COMPONENTS)).astype(np.int64)
        step = first[at[i]] + ((other & _U(0xFFFFFFFF)) % width[at[i]].astype(np.uint64)).astype(np.int64)
        valid = step < weight[at[i]]
        np.minimum.at(flat, row[at[i]][valid] * COMPONENTS + component[valid], time[i, j][valid])
        last, at = time[inside[:, -1], -1], at[inside[:, -1]]
        drawn += block
        block = min(2 * block, 256) if drawn > 8 else block


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Hash of each band with its number: a row of :data:`BANDS` per signature."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), BANDS, ROWS)
    found = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(signature), 1), np.uint64)
    for r in range(ROWS):
        found = _mix(found * _U(0x9E3779B97F4A7C15) + bits[:, :, r])
    return found.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``bag_hash`` and ``bands`` of every row; a text without a word has no hash and no bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch, texts in text_batches(batches, "text"):
            bags = [np.sort(shingles(t)) for t in texts]
            some = [i for i, b in enumerate(bags) if len(b)]
            hashes: list = [None] * len(texts)
            bands: list = [[]] * len(texts)
            if some:
                keys = band_keys(signatures([bags[i] for i in some]))
                for i, found in zip(some, keys, strict=True):
                    hashes[i] = xxhash.xxh3_128_digest(bags[i].tobytes())
                    bands[i] = found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "bag_hash", "bands"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id bigint, bag_hash binary, bands array<bigint>"
    )


def _tagged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``tag`` (:func:`_tag`) of rows whose ids may repeat; equal ones once, rows without a word not at all."""

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch, texts in text_batches(batches, "text"):
            bags = [np.sort(shingles(t)) for t in texts]
            hashes = [xxhash.xxh3_128_digest(b.tobytes()) if len(b) else None for b in bags]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.binary())], ["doc_id", "text", "bag_hash"])

    rows = docs.mapInArrow(tag, "doc_id bigint, text string, bag_hash binary").filter("bag_hash is not null")
    return rows.select("doc_id", "text", _tag(True).alias("tag")).dropDuplicates(["doc_id", "tag"])


def _tag(repeats: bool):
    """What tells the bags of one id apart; nothing has to where ids do not repeat."""
    return F.xxhash64("bag_hash") if repeats else F.lit(0).cast("bigint")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``a_tag``, ``b``, ``b_tag``) whose bags are similar, as (``a``, ``b``).

    Their texts are joined, never gathered.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in batches:
            rows = batch.to_pydict()
            near = []
            known: tuple = (None, None)
            for i, b in enumerate(rows["b"]):
                if known[0] != (b, rows["b_tag"][i]):
                    known = ((b, rows["b_tag"][i]), bag(rows["text_b"][i] or ""))
                near.append(overlap(bag(rows["text_a"][i] or ""), known[1]))
            yield pa.RecordBatch.from_pydict({c: [x for x, n in zip(rows[c], near, strict=True) if n] for c in ("a", "b")}, ends)

    ends = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    both = pairs
    for end in ("a", "b"):
        side = texts.select(F.col("id").alias(end), F.col("tag").alias(f"{end}_tag"), F.col("text").alias(f"text_{end}"))
        both = both.join(side, [end, f"{end}_tag"])
    return both.select("a", "b", "b_tag", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint")


def _blocks(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Similar pairs of different classes within the buckets of ``members`` (``bucket``, ``id``, ``tag``, ``class``).

    A bucket's members are dealt to blocks of about :data:`BLOCK` by a hash, and each two
    blocks of it meet in a group of their own, so no group grows with the bucket. A pair
    is compared in the first bucket it shares only.
    """
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    dealt = members.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("id", "tag", "bucket"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("other", other).select(
        "bucket", "id", "tag", "class", "part", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q")
    )
    full = dealt.join(texts, ["id", "tag"])

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        bucket, p, q = (k.as_py() for k in key)
        ids, classes, part = (table.column(c).to_numpy() for c in ("id", "class", "part"))
        order = np.argsort(ids)
        keys = np.array(table.column("bands").to_pylist(), np.int64)
        bags: dict[int, tuple] = {}
        found: list[tuple[int, int]] = []
        for x, i in enumerate(order):
            rest = order[x + 1 :]
            apart = classes[rest] != classes[i]
            # Two members of one part meet in the group of that part alone.
            apart &= (part[rest] != part[i]) | (p == q)
            rest = rest[apart]
            if not len(rest):
                continue
            same = keys[rest] == keys[i]
            rest = rest[keys[rest, same.argmax(axis=1)] == bucket]
            for j in rest:
                for k in (i, j):
                    if k not in bags:
                        bags[k] = bag(table.column("text")[int(k)].as_py() or "")
                if overlap(bags[i], bags[j]):
                    found.append((int(ids[i]), int(ids[j])))
        return pa.table({"a": [f[0] for f in found], "b": [f[1] for f in found]}, schema=ends)

    ends = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return full.groupBy("bucket", "p", "q").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` (the smallest id of its class) and ``kept``.

    Documents whose bags of five-word shingles have a weighted Jaccard similarity of 0.8
    or more are linked, and linked documents make a class; ``kept`` marks the one row of
    the class that carries the class's id (the same for all rows that share that id). Rows
    that share an id are one class, and each of their texts links it.
    Texts of one to four words have one shingle; a null text or a text without a word is
    near to nothing and its own class; a null id has class null and is kept. An empty
    table gives an empty result; other columns are ignored.

    Equal bags are one candidate. A bucket (documents with an equal band) is not paired
    up: its members are compared with one of them, the classes grow, and only buckets
    that still hold more than one class go on, with another member, and at last in blocks.
    """
    marked = written(signed(docs), "signatures")
    some = marked.filter("bag_hash is not null and doc_id is not null")
    firsts = some.groupBy("bag_hash").agg(F.min("doc_id").alias("id"))
    reps = some.join(firsts.select("bag_hash", F.col("id").alias("doc_id")), ["bag_hash", "doc_id"], "left_semi")
    reps = reps.dropDuplicates(["doc_id", "bag_hash"])
    # An id that stands on different texts has several bags; all of them are compared, and make one class.
    repeats = _repeats(marked)
    reps = reps.select(F.col("doc_id").alias("id"), _tag(repeats).alias("tag"), "bands")
    spread = reps.select("id", "tag", F.explode("bands").alias("bucket"))
    hubs = spread.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top")).filter("hub < top")
    members = written(spread.join(hubs.select("bucket", "hub"), "bucket"), "members")
    near = members.select(F.col("id").alias("doc_id")).distinct()
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(near, "doc_id", "left_semi")
    wanted = _tagged(wanted) if repeats else wanted.withColumn("tag", _tag(False))
    texts = written(wanted.withColumnRenamed("doc_id", "id").join(reps, ["id", "tag"]), "near-texts")
    first = members.filter("id = hub").groupBy("bucket").agg(F.min("tag").alias("hub_tag")) if repeats else None
    meet = members.filter("id > hub")
    meet = meet.join(first, "bucket") if repeats else meet.withColumn("hub_tag", _tag(False))
    pairs = meet.select(
        F.col("id").alias("a"), F.col("tag").alias("a_tag"), F.col("hub").alias("b"), F.col("hub_tag").alias("b_tag")
    ).distinct()
    labels = components(_verified(pairs, texts))
    members = members.select("bucket", "id", "tag")
    for turn in range(STAR_ROUNDS):
        open_members = _still_open(members, labels)
        if open_members.isEmpty():
            break
        if turn < STAR_ROUNDS - 1:
            # Another member of each bucket by turns; only members of other classes are compared with it.
            draw = F.xxhash64("id", "tag", "bucket", F.lit(turn))
            hub = F.min(F.struct(draw.alias("draw"), "id", "tag", "class"))
            hubs = open_members.groupBy("bucket").agg(hub.alias("hub"))
            meet = open_members.join(hubs, "bucket").filter("class <> hub.class")
            # The larger id first; of one id, there is one class.
            late = F.col("id") > F.col("hub.id")
            ends = [("a", late, "id"), ("a_tag", late, "tag"), ("b", ~late, "id"), ("b_tag", ~late, "tag")]
            pairs = meet.select(
                *[F.when(own, F.col(c)).otherwise(F.col(f"hub.{c}")).alias(name) for name, own, c in ends]
            ).distinct()
            links = written(_verified(pairs, texts), "found")
        else:
            links = written(_blocks(open_members, texts), "found")
        if not links.isEmpty():
            labels = _joined(labels, links)
        members = open_members.select("bucket", "id", "tag")
    label = labels.select(F.col("id").alias("_id"), "label")
    named = firsts.join(label, F.col("id") == F.col("_id"), "left").select("bag_hash", F.coalesce("label", "id").alias("class_id"))
    grouped = some.select("doc_id", "bag_hash").join(named, "bag_hash").select("doc_id", "class_id")
    alone = marked.filter("bag_hash is null or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, less those that :func:`near_duplicates` does not keep.

    Of rows that share both id and text one stays; rows with a null id all stay.
    """
    found = near_duplicates(docs)
    dropped = found.filter("not kept").select(F.col("doc_id").alias("_dropped")).distinct()
    rest = docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")
    if not _repeats(docs):
        return rest
    named = rest.filter("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return named.union(rest.filter("doc_id is null"))


def _repeats(marked: DataFrame) -> bool:
    """Whether ids occur more than once."""
    return not marked.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty()


def _still_open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their class, of the buckets that hold more than one class."""
    label = labels.select(F.col("id").alias("_id"), "label")
    classed = members.join(label, F.col("id") == F.col("_id"), "left")
    classed = classed.select("bucket", "id", "tag", F.coalesce("label", "id").alias("class"))
    mixed = classed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    return written(classed.join(mixed.select("bucket"), "bucket", "left_semi"), "open")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: only the links between classes are followed, then all labels renamed."""
    name = labels.select(F.col("id").alias("_id"), "label")
    ends = links
    for end in ("a", "b"):
        ends = ends.join(name, F.col(end) == F.col("_id"), "left").withColumn(end, F.coalesce("label", end)).drop("_id", "label")
    further = components(ends).select(F.col("id").alias("_from"), F.col("label").alias("_to"))
    renamed = labels.join(further, F.col("label") == F.col("_from"), "left")
    renamed = renamed.select("id", F.coalesce("_to", "label").alias("label"))
    # Classes of one document, and the former names of the classes that were joined.
    new = further.select(F.col("_from").alias("id"), F.col("_to").alias("label"))
    return written(renamed.union(new), "labels")
