"""Fill-in-the-middle: cuts texts at token boundaries that a roaring-style set of offsets looks up by number.

The offsets at which tokens end are kept in containers of 65,536 offsets: a sorted array,
a bitmap or a list of runs, whichever is smallest. Cumulative cardinalities find the
container of the k-th boundary, a select inside it the offset.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: Offsets a container spans.
SPAN = 1 << 16
SEED = 42
#: Of 100 documents, so many are cut; of 100 that are cut, so many put the suffix first.
CUT_PERCENT = 50
SPM_PERCENT = 80
#: Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_ARRAY, _BITMAP, _RUNS = range(3)


class BoundarySet:
    """A set of offsets, appended in rising order span by span, with select by number."""

    def __init__(self):
        self.containers: list[tuple[int, int, np.ndarray]] = []
        self.sizes: list[int] = []
        self.ends: np.ndarray | None = None

    def append(self, number: int, flags: np.ndarray) -> None:
        """The offsets ``number * SPAN + i`` for which ``flags[i]`` holds; at most SPAN flags."""
        places = np.flatnonzero(flags)
        if not len(places):
            return
        first = np.flatnonzero(np.diff(places, prepend=-2) > 1)
        # Bytes: two an offset, one bit an offset of the span, or four a run.
        cost = {_ARRAY: 2 * len(places), _BITMAP: SPAN // 8, _RUNS: 4 * len(first)}
        kind = min(cost, key=cost.get)
        if kind == _ARRAY:
            data = places.astype(np.uint16)
        elif kind == _BITMAP:
            data = np.zeros(SPAN // 8, np.uint8)
            packed = np.packbits(flags, bitorder="little")
            data[: len(packed)] = packed
        else:
            # Start of each run, and how many offsets the runs before it hold.
            data = np.stack([places[first], first]).astype(np.uint16)
        self.containers.append((number, kind, data))
        self.sizes.append(len(places))
        self.ends = None

    def __len__(self) -> int:
        return sum(self.sizes)

    def select(self, k: int) -> int:
        """The offset that has exactly ``k`` smaller ones in the set."""
        if self.ends is None:
            self.ends = np.cumsum(self.sizes)
        at = int(np.searchsorted(self.ends, k, side="right"))
        number, kind, data = self.containers[at]
        k -= int(self.ends[at]) - self.sizes[at]
        if kind == _ARRAY:
            low = int(data[k])
        elif kind == _BITMAP:
            words = data.view("<u8")
            counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            word = int(np.searchsorted(counts, k, side="right"))
            k -= int(counts[word - 1]) if word else 0
            bits = np.unpackbits(data[8 * word : 8 * word + 8], bitorder="little")
            low = 64 * word + int(np.flatnonzero(bits)[k])
        else:
            run = int(np.searchsorted(data[1], k, side="right")) - 1
            low = int(data[0, run]) + k - int(data[1, run])
        return number * SPAN + low


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def token_ends(data: np.ndarray) -> BoundarySet:
    """Last bytes of the tokens of a UTF-8 text: white space with the word after it, and white space at the end."""
    found = BoundarySet()
    for number, at in enumerate(range(0, len(data), SPAN)):
        blank = _blank(data[at : at + SPAN + 1])
        if at + SPAN >= len(data):
            # Behind the text: ends a word, and a blank before it ends a token of its own.
            flags = np.append(~blank[:-1] & blank[1:], True)
        else:
            flags = ~blank[:-1] & blank[1:]
        found.append(number, flags)
    return found


def code_point_ends(data: np.ndarray) -> BoundarySet:
    """Last bytes of the code points of a UTF-8 text."""
    found = BoundarySet()
    for number, at in enumerate(range(0, len(data), SPAN)):
        starts = (data[at : at + SPAN + 1] & 0xC0) != 0x80
        found.append(number, np.append(starts[1:], True) if at + SPAN >= len(data) else starts[1:])
    return found


UNITS = {"token": token_ends, "code point": code_point_ends}

_OUT = "{id} {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _numbers(seed: int, doc_id: object) -> list[int]:
    """Four 32-bit numbers that depend on the seed and the id alone; a null id is written as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def _code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT, unit: str = "token",
    id_col: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, units ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Two cuts between units, drawn from a hash of seed and id, part a text into prefix,
    middle and suffix. ``form`` says how ``output`` puts them: ``psm`` prefix, suffix,
    middle; ``spm`` suffix, prefix, middle, each behind its mark; ``plain`` the text as it
    is, for texts that are empty, hold a mark, or are not drawn; then both lengths, in code
    points, are null. ``unit`` is ``token`` (white space with the word behind it, white
    space at the end) or ``code point``. A null text is empty; ``n`` is 0 then. A null id
    counts as an empty one; rows that share an id are cut by the same numbers; repeated
    rows give equal rows; an empty table gives an empty result. Other columns are ignored.
    """
    ends_of = UNITS[unit]
    id_type = docs.schema[id_col].dataType
    marks = (PREFIX, SUFFIX, MIDDLE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            columns: list[list] = [[] for _ in range(5)]
            for doc_id, value in zip(batch.column(0).to_pylist(), texts, strict=True):
                raw = value.encode()
                data = np.frombuffer(raw, np.uint8)
                ends = ends_of(data)
                n = len(ends)
                h1, h2, h3, h4 = _numbers(seed, doc_id)
                if not n or h3 % 100 >= cut_percent or any(m in value for m in marks):
                    row = (n, "plain", None, None, value)
                else:
                    # Bytes before a cut behind k units.
                    first, second = (ends.select(k - 1) + 1 if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    prefix, middle, suffix = (raw[a:b].decode() for a, b in ((0, first), (first, second), (second, None)))
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    if form == "psm":
                        output = f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
                    else:
                        output = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
                    row = (n, form, _code_points(data[:first]), _code_points(data[first:second]), output)
                for column, cell in zip(columns, row, strict=True):
                    column.append(cell)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(cut, _OUT.format(id="id", id_type=id_type.simpleString()))
    return out.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No text that is cut holds a mark, so the marks part the output uniquely."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix = F.when(form == "psm", F.get(parts, 1)).otherwise(F.get(parts, 2))
    suffix = F.when(form == "psm", F.get(parts, 2)).otherwise(F.get(parts, 1))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, 3), suffix))
