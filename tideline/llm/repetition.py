"""Quality rules on repetition, from the suffix array of each text's words.

Only suffixes whose first words occur again can belong to a repeat, so the array is built
over those. It is sorted by prefix doubling; the longest common prefixes of neighbours in
the array give, for every suffix, the deepest prefix interval that holds it, which is the
longest repeat that starts there. Their spans, united, are the words that repeats cover.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import text_batches

WINDOW = 5
MIN_WORDS = 10
MAX_COVERED_PERCENT = 20
MAX_LONGEST = 64
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def repeat_spans(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths (in words) of the longest repeats of at least ``window`` words, one per suffix that starts one."""
    n = len(words)
    none = np.empty(0, np.int64)
    if n <= window:
        return none, none
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    m = n - window + 1
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    keys = np.zeros(m, np.uint64)
    for k in range(window):
        keys = keys * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + m]
    order = np.argsort(keys, kind="stable")
    twin = np.zeros(m + 1, bool)
    twin[1:m] = keys[order[1:]] == keys[order[:-1]]
    at = np.sort(order[twin[:-1] | twin[1:]])
    if not len(at):
        return none, none
    # Exact ranks of every position's first window, in the order of its words: one word more at a time.
    padded = np.concatenate([ids + 1, np.zeros(window, np.int64)])
    base = padded[:n]
    for k in range(1, window):
        base = np.unique(base * (len(known) + 1) + padded[k : k + n], return_inverse=True)[1]
    base = np.append(base + 1, 0)
    rank = np.unique(base[at], return_inverse=True)[1]
    levels, reach = [], window
    # place[p]: where position p stands among the survivors, -1 if its window occurs once.
    place = np.full(n + 1, -1, np.int64)
    place[at] = np.arange(len(at))
    while True:
        levels.append((reach, rank))
        if len(at) == rank.max() + 1 or reach >= n:
            break
        after = np.minimum(at + reach, n)
        # Ranked by the window there, then, if that one occurs again, by what is known of its suffix.
        further = base[after] * (len(at) + 1) + np.where(place[after] >= 0, rank[place[after]] + 1, 0)
        further = np.unique(further, return_inverse=True)[1]
        rank = np.unique(rank * (further.max() + 1) + further, return_inverse=True)[1]
        reach *= 2
    array = np.argsort(rank, kind="stable")
    a, b = at[array[:-1]], at[array[1:]]
    common = np.zeros(len(a), np.int64)
    for reach, rank in reversed(levels):
        i, j = place[np.minimum(a + common, n)], place[np.minimum(b + common, n)]
        both = (i >= 0) & (j >= 0) & (i != j)
        both[both] = rank[i[both]] == rank[j[both]]
        common[both] += reach
    going = np.ones(len(a), bool)
    for _ in range(window):
        i, j = np.minimum(a + common, n), np.minimum(b + common, n)
        going &= (padded[i] == padded[j]) & (padded[i] > 0)
        common[going] += 1
    longest = np.zeros(len(at), np.int64)
    longest[array[:-1]] = common
    longest[array[1:]] = np.maximum(longest[array[1:]], common)
    kept = longest >= window
    return at[kept], longest[kept]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> int:
    """Size of the union of the spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def _measures(text: str) -> tuple[int, int, int, int, int, int]:
    words = text.encode().split()
    starts, lengths = repeat_spans(words)
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            again += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        again,
        covered(starts, lengths, len(words)),
        int(lengths.max(initial=0)),
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat")


def _verdicts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of the texts, whether the base rules fail them, and whether they are kept."""
    found = np.array([_measures(t) for t in texts], dtype=np.int64).reshape(len(texts), len(MEASURES))
    words, repeated, longest = (found[:, MEASURES.index(m)] for m in ("n_words", "n_repeat_words", "longest_repeat"))
    too_much = 100 * repeated > MAX_COVERED_PERCENT * words
    failed = (words < MIN_WORDS) | too_much
    return found, failed, ~failed & (longest <= MAX_LONGEST)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, the measures of its whole text, ``base_failed`` and ``kept``.

    ``n_repeat_words`` are the words that repeats of five or more words cover, their
    first place included; ``longest_repeat`` is the longest such repeat in words (it may
    overlap itself). ``base_failed``: fewer than 10 words, or repeats cover more than
    20 % of them. ``kept``: not failed, and the suffix array's verdict: repeats cover at
    most 20 % of the words and none is longer than 64 words.

    A null or empty text has all measures 0 and fails. Rows that repeat are measured
    each; an empty table gives an empty result; other columns are ignored.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch, texts in text_batches(batches, "text"):
            found, failed, kept = _verdicts(texts)
            columns = [batch.column(0), *map(pa.array, found.T.copy()), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, ["id", *MEASURES, "base_failed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    schema = f"id {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", base_failed boolean, kept boolean"
    return rows.mapInArrow(measure, schema).withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text :func:`quality_rules` keeps."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch, texts in text_batches(batches, text):
            yield batch.filter(pa.array(_verdicts(texts)[2]))

    return docs.mapInArrow(keep, docs.schema)
