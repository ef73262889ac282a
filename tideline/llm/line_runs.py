"""Drops lines that stand in many documents; levelled sorted runs of line hashes, DataFrame expressions only.

The hashes of a batch of documents become a run: a table bucketed and sorted by hash that
holds each hash once with its number of documents. Runs of one level are merged into one
of the next as soon as there are ``fan_in`` of them, so that n batches leave about log n
runs. Runs have equal buckets, so merging runs and anti-joining a batch with them are
merge joins that move nothing of the runs.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import written

#: Lines in so many documents are dropped, if their key has so many code points.
MIN_DOCS = 10
MIN_CHARS = 1
#: Batches a whole table is dealt to, and runs of a level that are merged into one.
BATCHES = 4
FAN_IN = 2
#: Hashes in a bucket, about.
BUCKET_ROWS = 8_000_000
#: A key is heavy above this share of all (document, key) pairs: fewer keys than the divisor can be.
HEAVY_DIVISOR = 4096

_BLANK = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_MANIFEST = "at bigint, name string, level int, buckets int, replaces array<string>"


def line_key(line: Column) -> Column:
    """The line without blanks and the controls 9 to 13 at both ends, A to Z in lower case; other letters stay."""
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _UPPER.lower())


def _hash(key: Column, min_chars: int) -> Column:
    """Half of the key's SHA-256 in hex, null for a key too short to count."""
    return F.when(F.length(key) >= max(min_chars, 1), F.substring(F.sha2(key, 256), 1, 32))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """The runs of one folder. One writer at a time; folders of runs that were merged may be deleted.

    A folder's manifest has one row per run and the names of those it replaces.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int, fan_in: int = FAN_IN):
        self.spark, self.folder, self.buckets, self.fan_in = spark, folder, buckets, fan_in
        self.made = 0
        self.live: list[tuple[str, int]] = []

    @classmethod
    def reopen(cls, spark: SparkSession, folder: str, fan_in: int = FAN_IN) -> LineRuns:
        """The runs that an earlier session left in ``folder``."""
        rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").orderBy("at").collect()
        runs = cls(spark, folder, rows[0]["buckets"], fan_in)
        runs.made = rows[-1]["at"] + 1
        gone = {name for row in rows for name in row["replaces"]}
        runs.live = [(row["name"], row["level"]) for row in rows if row["name"] not in gone]
        for name, _ in runs.live:
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} (hash BINARY, n_docs BIGINT) USING parquet "
                f"CLUSTERED BY (hash) SORTED BY (hash) INTO {runs.buckets} BUCKETS LOCATION '{folder}/{name}'"
            )
        return runs

    def _write(self, rows: DataFrame, level: int, replaces: list[str]) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, "hash").sortBy("hash").format("parquet")
        writer.option("path", f"{self.folder}/{name}").saveAsTable(name)
        entry = self.spark.createDataFrame([(self.made, name, level, self.buckets, replaces)], _MANIFEST)
        entry.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        self.made += 1
        self.live = [run for run in self.live if run[0] not in replaces] + [(name, level)]
        for old in replaces:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")

    def _merged(self, names: list[str]) -> DataFrame:
        def merge(left: DataFrame, right: DataFrame) -> DataFrame:
            other = right.select(F.col("hash").alias("_hash"), F.col("n_docs").alias("_n"))
            both = left.join(other, F.col("hash") == F.col("_hash"), "full")
            total = F.coalesce("n_docs", F.lit(0)) + F.coalesce("_n", F.lit(0))
            return both.select(F.coalesce("hash", "_hash").alias("hash"), total.alias("n_docs"))

        return reduce(merge, [self.spark.table(name) for name in names])

    def add(self, hashes: DataFrame) -> None:
        """Adds a batch: one row ``hash`` (binary) for each document and each of its keys; merges full levels."""
        counts = hashes.groupBy("hash").agg(F.count("*").alias("n_docs"))
        self._write(counts.repartition(self.buckets, "hash"), 0, [])
        level = 0
        while len(names := [name for name, at in self.live if at == level]) >= self.fan_in:
            self._write(self._merged(names), level + 1, names)
            level += 1

    def totals(self) -> DataFrame:
        """(``hash``, ``n_docs``) over all runs; at least one batch must be there."""
        return self._merged([name for name, _ in self.live])


def _staged(docs: DataFrame, min_chars: int, batches: int, id_col: str, text: str) -> DataFrame:
    """Rows (``id``, ``sign``, ``hashes`` by line, null where a line has no key that counts, ``batch``), written once.

    ``sign`` tells texts apart that share an id.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    hashes = F.transform(_lines(F.col(text)), lambda line: _hash(line_key(line), min_chars))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(whole).alias("sign"), hashes.alias("hashes"))
    batch = F.pmod(F.xxhash64("id", "sign"), F.lit(batches)).cast("int")
    return written(rows.withColumn("batch", batch), "line-hashes")


def _document_hashes(staged: DataFrame) -> DataFrame:
    """A row ``hash`` for each document and each of its keys."""
    each = staged.select(F.explode(F.array_distinct("hashes")).alias("hash")).filter("hash IS NOT NULL")
    return each.select(F.unhex("hash").alias("hash"))


def _without(docs: DataFrame, staged: DataFrame, runs: LineRuns, min_docs: int, id_col: str, text: str) -> DataFrame:
    """Texts without the lines whose hash the runs hold with ``min_docs`` documents or more."""
    frequent = runs.totals().filter(F.col("n_docs") >= min_docs)
    # Heavy keys go out before anything is moved: at most HEAVY_DIVISOR rows, each above that share of all pairs.
    pairs = _document_hashes(staged).count()
    heavy = frequent.filter(F.col("n_docs") * HEAVY_DIVISOR > pairs).select("hash")
    lines = staged.select("id", "sign", F.posexplode("hashes").alias("pos", "hash"))
    blank = lines.filter("hash IS NULL").drop("hash")
    keyed = lines.filter("hash IS NOT NULL").withColumn("hash", F.unhex("hash"))
    keyed = keyed.join(F.broadcast(heavy), "hash", "left_anti")
    kept = keyed.join(frequent.select("hash"), "hash", "left_anti").drop("hash").unionByName(blank)
    # A set: rows that share id and text keep the same lines.
    places = kept.groupBy("id", "sign").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    places = places.withColumnsRenamed({"id": "_id", "sign": "_sign"})
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(F.col(id_col).alias("id"), F.xxhash64(whole).alias("sign"), _lines(F.col(text)).alias("lines"))
    both = split.join(places, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sign") == F.col("_sign")), "left")
    left = F.coalesce(F.size("places"), F.lit(0))
    rest = F.transform(F.coalesce("places", F.array().cast("array<int>")), lambda i: F.get(F.col("lines"), i))
    n = F.size("lines")
    return both.select(
        F.col("id").alias(id_col), n.cast("bigint").alias("n_lines"), (n - F.when(F.col("places").isNull(), 0).otherwise(left)).cast("bigint").alias("n_dropped"),
        F.array_join(rest, "\n").alias("text"),
    )


def buckets_for(staged: DataFrame) -> int:
    """Buckets that hold about BUCKET_ROWS hashes each, at least as many as shuffles have partitions."""
    rows = staged.select(F.sum(F.size("hashes"))).first()[0] or 0
    return max(int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES, fan_in: int = FAN_IN,
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_lines`` before, ``n_dropped``, and ``text`` without the dropped lines.

    Lines end at \\n. All lines go whose key (:func:`line_key`) has at least ``min_chars``
    code points and is found in at least ``min_docs`` rows; a row counts once for each of
    its keys, and rows that repeat count each. The batches are added to the runs one by
    one, then all lines anti-join the runs. A null or empty text is one empty line; empty
    keys always stay; a text all of whose lines go is empty; null and repeated ids do no
    harm; an empty table gives an empty result. Other columns are ignored.
    """
    staged = _staged(docs, min_chars, batches, id_col, text)
    runs = LineRuns(docs.sparkSession, shared_dir(docs.sparkSession, "llm-line-runs"), buckets_for(staged), fan_in)
    for batch in range(batches):
        runs.add(_document_hashes(staged.filter(F.col("batch") == batch)))
    return _without(docs, staged, runs, min_docs, id_col, text)


def admit(
    docs: DataFrame, runs: LineRuns, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A new batch of documents against all that came before: adds its hashes to ``runs``, and drops the lines that
    by then stand in ``min_docs`` rows or more. Columns and odd cases as in :func:`drop_frequent_lines`.
    """
    staged = _staged(docs, min_chars, 1, id_col, text)
    runs.add(_document_hashes(staged))
    return _without(docs, staged, runs, min_docs, id_col, text)
