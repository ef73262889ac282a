"""Pre-tokens and their ids for the files of the tokenizers library, through caches of the worker.

The library spends most of its time on pieces of text it has met before. Here a text is
cut into pre-tokens by a pattern equal to that of the file, and each distinct pre-token is
encoded by the library once per worker. Texts with characters outside the range in which
pattern and library were found equal, and texts that hold a special token, go to the
library whole, so the ids are always the library's own.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable
from functools import cache

import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Longer pre-tokens are encoded each time, not kept.
KEPT_LENGTH = 64
#: Pre-tokens in one of the two generations a worker keeps.
KEPT_PIECES = 1_000_000


def _class(kind: str, end: int) -> str:
    """The characters below ``end`` whose Unicode category starts with ``kind``, as a pattern's class."""
    spans: list[list[int]] = []
    for c in range(end):
        if unicodedata.category(chr(c)).startswith(kind):
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in spans)


@cache
def _byte_level() -> tuple[re.Pattern, re.Pattern]:
    letter, number = _class("L", 0x530), _class("N", 0x530)
    # Letters stand first: no other alternative can begin where they do.
    piece = rf" ?[{letter}]+| ?[{number}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+"
    # The separators 28 to 31 are no white space in the library.
    return re.compile(piece), re.compile(r"[^\u0000-\u001b\u0020-\u052f\u2010-\u205e]")


@cache
def _word_level() -> tuple[re.Pattern, re.Pattern]:
    letter, number = _class("L", 0x530), _class("N", 0x530)
    piece = rf"[{letter}]+|[{number}]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{letter}{number}]+"
    # Below the combining marks, so that every text is in composed form already, and below the
    # letters whose small forms lie far off; the separators 28 to 31 are no white space there.
    return re.compile(piece), re.compile(r"[^\u0000-\u001b\u0020-\u0239\u2010-\u2027\u2030-\u205e]")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level files: visible Latin ones stand for themselves."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class Splitter:
    """Cuts texts into the pre-tokens of a tokenizer file, where that can be done outside the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        self.special = [t["content"] for t in form["added_tokens"]]
        before, normal = form["pre_tokenizer"] or {}, form["normalizer"] or {}
        self.lower = False
        self.piece = self.unsafe = None
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
            self.piece, self.unsafe = _byte_level()
        elif [n.get("type") for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and [
            (p.get("type"), p.get("behavior"), p.get("invert")) for p in before.get("pretokenizers", [])[:1]
        ] == [("Split", "Removed", True)]:
            self.piece, self.unsafe = _word_level()
            self.lower = True

    def unsafe_text(self, text: str) -> bool:
        """Whether only the library may cut the text."""
        return self.piece is None or any(s in text for s in self.special) or self.unsafe.search(text) is not None

    def split(self, text: str) -> list[str] | None:
        """The pre-tokens, or None where only the library may cut the text."""
        if self.unsafe_text(text):
            return None
        return self.piece.findall(text.lower() if self.lower else text)

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of one pre-token: only the merges are left to do."""
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_LETTERS))]

    def ids(self, text: str) -> list[int]:
        """Ids of any text."""
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceCache(dict):
    """Value of each pre-token: frequent ones for good, others for two generations.

    A full generation becomes the old one, and what is met again moves to the new one, so
    a large vocabulary drops what it has not met for long instead of all at once.
    """

    def __init__(self, splitter: Splitter, value: Callable, frequent: dict):
        super().__init__(frequent)
        self.splitter, self.value, self.frequent = splitter, value, frequent
        self.old: dict = {}

    def __missing__(self, piece: str):
        found = self.old.get(piece)
        if found is None:
            found = self.value(self.splitter.piece_ids(piece))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES + len(self.frequent):
                self.old = dict(self)
                self.clear()
                self.update(self.frequent)
            self[piece] = found
        return found


_WORKER: dict = {}


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def splitter(path: str) -> Splitter:
    """This worker's splitter of a file."""
    if path not in _WORKER:
        _WORKER[path] = Splitter(path)
    return _WORKER[path]


def piece_cache(path: str, value: Callable, key: object = None, frequent: Callable[[], dict] = dict) -> PieceCache:
    """This worker's cache for a file and a kind of value; a new ``key`` replaces it, seeded by ``frequent``."""
    name = (path, value)
    if name not in _WORKER or _WORKER[name][0] != key:
        _WORKER[name] = (key, PieceCache(splitter(path), value, frequent()))
    return _WORKER[name][1]


def forget() -> None:
    """Gives back the caches of this worker and unused Arrow memory; operators that do without call it, as workers outlive jobs."""
    if _WORKER:
        _WORKER.clear()
    pa.default_memory_pool().release_unused()


def encoded(path: str, text: str) -> bytes:
    """The ids of a whole text as :func:`id_bytes`."""
    pieces = splitter(path).split(text)
    if pieces is None:
        return id_bytes(splitter(path).ids(text))
    return b"".join(map(piece_cache(path, id_bytes).__getitem__, pieces))
