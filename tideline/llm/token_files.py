"""Token ids in files: one zstandard frame per document, all with one trained dictionary.

A dataset has two Parquet folders. ``dictionary`` holds the dictionary and its SHA-256.
``shards`` holds a row per shard: the hash of the dictionary its frames need, the ids of
its documents with the offsets of their frames (the index), and the frames one after the
other (``payload``). A frame is the document's ids as little-endian unsigned 32-bit
integers. The index columns are read without the payload, and the statistics of
``first_id`` and ``last_id`` lead to the one shard of a document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import tokens
from .common import text_batches

#: Compressed bytes after which a shard is closed. A longer document makes a shard of its own.
SHARD_BYTES = 2 << 20
DICTIONARY_BYTES = 1 << 16
#: The dictionary is trained on at most this many documents, chosen by a hash over the whole table, ...
SAMPLE_DOCUMENTS = 1000
#: ... and on at most this much of each.
SAMPLE_BYTES = 1 << 15
LEVEL = 3

SHARD_SCHEMA = (
    "part int, shard int, dictionary_sha256 string, first_id bigint, last_id bigint, tokens_before bigint, "
    "n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, offsets array<bigint>, payload binary"
)
_SHARD_ARROW = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("dictionary_sha256", pa.string()), ("first_id", pa.int64()),
    ("last_id", pa.int64()), ("tokens_before", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
    ("payload", pa.binary()),
])


def train_dictionary(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text: str = "text") -> bytes:
    """A dictionary for the ids of ``docs``; empty where there is too little to learn from."""
    rows = docs.count()
    # About twice as many pass the filter, so that the ordered cut has little to order.
    rate = min(1.0, 2 * SAMPLE_DOCUMENTS / max(rows, 1))
    draw = F.xxhash64(F.col(id_col), F.col(text))
    few = F.pmod("_draw", F.lit(1 << 53)) <= F.lit(int(rate * (1 << 53)))
    end = tokens.id_bytes([end_id])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_batches(batches, text):
            yield pa.RecordBatch.from_pydict({"ids": [(tokens.encoded(path, t) + end)[:SAMPLE_BYTES] for t in texts]})

    drawn = docs.select(draw.alias("_draw"), F.col(text).alias(text)).filter(few).orderBy("_draw").limit(SAMPLE_DOCUMENTS)
    found = drawn.select(text).mapInArrow(sample, "ids binary").collect()
    samples = sorted(bytes(r["ids"]) for r in found)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, d=8, k=256, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _options(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_token_files(
    docs: DataFrame, path: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text: str = "text"
) -> str:
    """Encodes every text, appends ``end_id`` and writes the dataset to ``folder`` in ascending order of the ids.

    A null text is empty: its document has the end id alone. Null ids come first; rows
    that share an id follow each other in the order of a hash of their texts. An empty table gives a dataset
    without shards. Other columns are ignored.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, path, end_id, id_col, text)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(
        f"{folder}/dictionary"
    )
    end = tokens.id_bytes([end_id])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = zstandard.ZstdCompressor(level=LEVEL, **_options(dictionary))
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        sizes: list[int] = []
        offsets: list[int] = []
        frames: list[bytes] = []
        at = 0

        def closed() -> pa.RecordBatch:
            # Null ids come first; the index spans the others.
            least = next((i for i in ids if i is not None), None)
            row = (part, shard, digest, least, ids[-1], before, sum(sizes), ids, sizes, offsets, b"".join(frames))
            return pa.RecordBatch.from_pydict({f.name: [v] for f, v in zip(_SHARD_ARROW, row, strict=True)}, _SHARD_ARROW)

        for batch, texts in text_batches(batches, "text"):
            for doc_id, value in zip(batch.column(0).to_pylist(), texts, strict=True):
                raw = tokens.encoded(path, value) + end
                frame = packer.compress(raw)
                ids.append(doc_id)
                sizes.append(len(raw) // 4)
                offsets.append(at)
                frames.append(frame)
                at += len(frame)
                if at >= SHARD_BYTES:
                    yield closed()
                    shard, before, at = shard + 1, before + sum(sizes), 0
                    ids, sizes, offsets, frames = [], [], [], []
        if ids:
            yield closed()

    ordered = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    ordered = ordered.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    # The frames are compressed already.
    ordered.mapInArrow(pack, SHARD_SCHEMA).write.option("compression", "none").parquet(f"{folder}/shards")
    return folder


def _read(spark: SparkSession, folder: str) -> tuple[DataFrame, bytes, str]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards"), bytes(row["dictionary"]), row["sha256"]


def _frames(row: dict) -> Iterator[tuple[int | None, int, bytes]]:
    stops = [*row["offsets"][1:], len(row["payload"])]
    for doc_id, size, a, b in zip(row["doc_ids"], row["doc_tokens"], row["offsets"], stops, strict=True):
        yield doc_id, size, row["payload"][a:b]


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """The documents of a dataset: id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    ``with_ids`` adds ``ids``, the document's ids. A shard whose dictionary hash is not
    that of the dictionary raises an error.
    """
    shards, dictionary, digest = _read(spark, folder)
    # One number per partition of the writing job: the only thing that has to be known in order.
    starts: dict[int, int] = {}
    total = 0
    for row in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        starts[row["part"]] = total
        total += row["n"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor(**_options(dictionary))
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["dictionary_sha256"] != digest:
                    raise ValueError("a shard needs another dictionary")
                at = starts[row["part"]] + row["tokens_before"]
                out: dict = {"id": [], "start": [], "n_tokens": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
                for doc_id, size, frame in _frames(row):
                    raw = reader.decompress(frame)
                    out["id"].append(doc_id)
                    out["start"].append(at)
                    out["n_tokens"].append(len(raw) // 4)
                    out["ids_crc32"].append(zlib.crc32(raw))
                    if with_ids:
                        out["ids"].append(memoryview(raw).cast("I").tolist())
                    at += size
                yield pa.RecordBatch.from_pydict(out)

    schema = "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    needed = shards.select("part", "dictionary_sha256", "tokens_before", "doc_ids", "doc_tokens", "offsets", "payload")
    return needed.mapInArrow(unpack, schema).withColumnRenamed("id", id_col)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[int] | None:
    """The ids of one document (the first, if several share the id), by index: only its shard's frames are read."""
    shards, dictionary, _ = _read(spark, folder)
    rows = shards.filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).filter(
        F.array_contains("doc_ids", F.lit(doc_id).cast("bigint"))
    )
    at = F.array_position("doc_ids", F.lit(doc_id).cast("bigint")).cast("int")
    start = F.element_at("offsets", at)
    stop = F.coalesce(F.try_element_at("offsets", at + 1), F.octet_length("payload"))
    row = rows.select("part", "shard", F.substring("payload", start.cast("int") + 1, (stop - start).cast("int")).alias("frame"))
    found = row.orderBy("part", "shard").first()
    if found is None:
        return None
    raw = zstandard.ZstdDecompressor(**_options(dictionary)).decompress(bytes(found["frame"]))
    return memoryview(raw).cast("I").tolist()


def token_file_round_trip(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Writes ``docs`` to a new dataset in the shared folder and reads it back."""
    folder = write_token_files(docs, path, shared_dir(docs.sparkSession, "llm-token-files"), end_id)
    return read_token_files(docs.sparkSession, folder)
