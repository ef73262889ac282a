import random
import zlib

import numpy as np
import pytest
from llm_cases import EDGE_TEXTS, texts_of
from tokenizers import Tokenizer

from tideline.llm import packing, token_counts, token_files, tokens
from tideline.llm.queries import BYTE_BPE, WORD_BPE, tokenizer_path
from tideline.session import shared_dir


def library(name):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_ids_are_the_librarys(name, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)
    monkeypatch.setattr(tokens, "_WORKER", {})
    whole = library(name)
    chars = [chr(c) for c in (*range(0x560), *range(0x2000, 0x2070), 0x3042, 0x4E00, 0x1F600)]
    draw = random.Random(5)
    texts = ["".join(draw.choices(chars, k=60)) for _ in range(300)]
    texts += ["".join(draw.choices("ab 's'll\n\t1.,'", k=200)) for _ in range(100)] + [t or "" for _, t in EDGE_TEXTS]
    for text in texts:
        assert tokens.encoded(tokenizer_path(name), text) == tokens.id_bytes(whole(text))


def test_every_safe_character_alone():
    for name in (BYTE_BPE, WORD_BPE):
        splitter, whole = tokens.Splitter(tokenizer_path(name)), library(name)
        for c in range(0x2100):
            text = f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}  {chr(c)}"
            pieces = splitter.split(text)
            if pieces is not None:
                assert [i for p in pieces for i in splitter.piece_ids(p)] == whole(text), hex(c)


def test_every_safe_character_before_others():
    for name in (BYTE_BPE, WORD_BPE):
        splitter, whole = tokens.Splitter(tokenizer_path(name)), library(name)
        for c in range(0x2100):
            for after in ("'s", "'ll go", " 't", "  x", "x"):
                for text in (f"it{chr(c)}{after}", f"x {chr(c)}{after}", f"{chr(c)}{chr(c)}{after}"):
                    pieces = splitter.split(text)
                    if pieces is not None:
                        assert [i for p in pieces for i in splitter.piece_ids(p)] == whole(text), (hex(c), after)


def test_counts(edge, empty, small):
    whole = library(BYTE_BPE)
    for docs in (edge, small):
        found = token_counts.count_tokens(docs, tokenizer_path(BYTE_BPE)).collect()
        wanted = sorted(
            ((i if i is not None else -1, len((t or "").encode()), len(whole(t)), len(whole(t)) > 1024) for i, t in texts_of(docs))
        )
        assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in found) == wanted
    assert token_counts.count_tokens(empty, tokenizer_path(BYTE_BPE)).collect() == []


def test_sketches_merge_in_rounds(small, monkeypatch):
    """Five partitions, two at a time: three rounds give the counts that one would."""
    monkeypatch.setattr(token_counts, "FAN_IN", 2)
    path = tokenizer_path(BYTE_BPE)
    docs = small.repartition(5)
    pieces = token_counts.frequent_pieces(docs, path)
    monkeypatch.setattr(token_counts, "FAN_IN", 16)
    assert sorted(pieces) == sorted(token_counts.frequent_pieces(docs, path)) and len(pieces) == len(set(pieces)) > 100


def test_rows_that_share_an_id_have_one_order(spark, monkeypatch):
    """Whatever order they come in; and the dictionary takes no more documents than it says."""
    monkeypatch.setattr(token_files, "SAMPLE_DOCUMENTS", 30)
    rows = [(k % 7, f"text {k} of some words " * (k % 5 + 1)) for k in range(200)]
    found = []
    for turn in (1, -1):
        docs = spark.createDataFrame(rows[::turn], "doc_id bigint, text string").repartition(3)
        found.append(sorted(map(tuple, token_files.token_file_round_trip(docs, tokenizer_path(BYTE_BPE)).collect())))
    assert found[0] == found[1] and len(found[0]) == 200
    taken = []
    monkeypatch.setattr(token_files.zstandard, "train_dictionary", lambda size, samples, **_: taken.append(len(samples)) or _fail())
    token_files.train_dictionary(docs, tokenizer_path(BYTE_BPE))
    assert 0 < taken[0] <= 30


def _fail():
    raise token_files.zstandard.ZstdError("nothing to learn")


def test_token_files(spark, edge, empty, small, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 4000)
    whole = library(BYTE_BPE)
    for docs in (edge, small):
        folder = token_files.write_token_files(docs, tokenizer_path(BYTE_BPE), shared_dir(spark, "test-files"))
        rows = token_files.read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
        assert [r["doc_id"] for r in rows] == [i for i, _ in texts_of(docs)]
        at = 0
        for row in rows:
            assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(row["ids"]), crc(row["ids"]))
            at += row["n_tokens"]
        wanted = sorted((i if i is not None else -1, [*whole(t), 0]) for i, t in texts_of(docs))
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"]) for r in rows) == wanted
        some = [i for i, _ in texts_of(docs) if i is not None][::7]
        for i in some:
            assert token_files.read_document(spark, folder, i) == dict(wanted)[i]
    assert token_files.read_document(spark, folder, 10**9) is None
    assert token_files.token_file_round_trip(empty, tokenizer_path(BYTE_BPE)).collect() == []


def check_packed(rows, documents, max_length):
    wanted = sorted(
        (i if i is not None else -1, p, s, len(ids[s : s + max_length]), crc(ids[s : s + max_length]))
        for i, ids in documents
        for p, s in enumerate(range(0, len(ids), max_length))
    )
    assert sorted((r[0] if r[0] is not None else -1, *r[1:5]) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= max_length
    return len(sequences)


def test_packing(edge, empty, small):
    whole = library(WORD_BPE)
    for docs, max_length in ((edge, 2048), (small, 2048), (small, 300)):
        documents = [(i, [*whole(t), 0]) for i, t in texts_of(docs)]
        rows = packing.pack_documents(docs, tokenizer_path(WORD_BPE), max_length).collect()
        n = check_packed(rows, documents, max_length)
        total = sum(len(ids) for _, ids in documents)
        assert n <= 1.02 * total / max_length + 1
    assert packing.pack_documents(empty, tokenizer_path(WORD_BPE)).collect() == []


def test_sequences_hold_the_ids(small):
    placed = packing.pack_documents(small, tokenizer_path(WORD_BPE), with_ids=True)
    whole = library(WORD_BPE)
    ids = {i: [*whole(t), 0] for i, t in texts_of(small)}
    pieces = {(r["sequence_id"], r["offset"]): ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in placed.collect()}
    for row in packing.sequences(placed).collect():
        parts = [v for k, v in sorted(pieces.items()) if k[0] == row["sequence_id"]]
        assert row["ids"] == [i for part in parts for i in part]


def least_sequences(histogram, size):
    """No packing needs fewer: long pieces need a sequence each, others what does not fit beside them."""
    length = np.arange(size + 1)
    tokens = length * histogram
    best = 0
    for shortest in range(size // 2 + 1):
        alone = histogram[size - shortest + 1 :].sum()
        long = (length > size // 2) & (length <= size - shortest)
        rest = (length >= shortest) & (length <= size // 2)
        over = tokens[rest].sum() + tokens[long].sum() - size * histogram[long].sum()
        best = max(best, int(alone + histogram[long].sum() + max(0, -(-over // size))))
    return best


@pytest.mark.parametrize("size", [1, 7, 64, 2048, 5000])
def test_plans_use_up_the_histogram(size):
    draw = np.random.default_rng(size)
    for kind in ("few", "many", "short", "none"):
        histogram = np.zeros(size + 1, np.int64)
        if kind == "few":
            histogram[draw.integers(1, size + 1, 5)] = draw.integers(1, 1000, 5)
        elif kind == "many":
            histogram[1:] = draw.integers(0, 50, size)
        elif kind == "short":
            histogram[1 : min(size, 9) + 1] = 12345
        plan = packing.pack_histogram(histogram, size)
        used = np.zeros(size + 1, np.int64)
        for pattern, n in plan:
            assert 0 < sum(pattern) <= size and n > 0
            for length in pattern:
                used[length] += n
        assert (used == histogram).all()
        if size >= 64 and kind in ("many", "short"):
            assert sum(n for _, n in plan) <= 1.01 * least_sequences(histogram, size) + 2
