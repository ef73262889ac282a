"""Line dedup, fill-in-the-middle and alignment against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from llm_cases import EDGE_TEXTS

from tideline.llm import alignment, fill_in_middle, line_runs, tokens
from tideline.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path
from tideline.session import shared_dir

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (20, "a▁b"), (21, "tail "), (22, "\n\nx\n y"), (23, "<|endoftext|>"), (24, "x<|endoftext|> <s></s><unk><0x0A>"),
    (25, "\x00\x1c's é 漢字漢字 😀"), (26, "\xa0　  x"), (27, "   "), (28, "\t"), (29, "<P>a"), (30, "İ ﬁ ß"),
]


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# Lines


def key_of(line):
    return line.strip(BLANKS).translate(LOWER)


def dropped_lines(rows, min_docs, min_chars=1, more=()):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    seen = collections.Counter(k for _, ls in [*split, *[(None, (t or "").split("\n")) for _, t in more]] for k in {key_of(x) for x in ls})
    out = []
    for i, ls in split:
        kept = [x for x in ls if len(key_of(x)) < max(min_chars, 1) or seen[key_of(x)] < min_docs]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return order(out)


LINES = [
    *[(100 + i, "Same Line\n\n " + "same line\t\nonly " + str(i)) for i in range(4)],
    (104, "SAME LINE"), (105, "\x0b\x0c same line \r\nÀ bientôt\nà bientôt"), (106, "À bientôt"), (107, "À BIENTÔT\n\n\n"),
    (None, "same line\nx"), (None, "same line\nx"), (108, "x\nx\nx"), (109, "x"),
]


@pytest.mark.parametrize("batches, fan_in, min_docs, min_chars", [(1, 2, 3, 1), (4, 2, 3, 1), (5, 3, 2, 2), (3, 4, 1, 0)])
def test_lines(spark, batches, fan_in, min_docs, min_chars):
    rows = EDGE_TEXTS + ODD + LINES
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = line_runs.drop_frequent_lines(docs, min_docs, min_chars, batches, fan_in).collect()
    assert order(found) == dropped_lines(rows, min_docs, min_chars)


def test_lines_of_the_given_documents(spark, small):
    found = line_runs.drop_frequent_lines(small).collect()
    assert order(found) == dropped_lines(pairs_of(small), 10)
    assert sum(r["n_dropped"] for r in found) > 0


def test_lines_of_a_hot_group_go_before_the_join(spark, monkeypatch):
    monkeypatch.setattr(line_runs, "HEAVY_DIVISOR", 4)
    rows = [(i, f"common\nown {i}\npair {i // 2}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (2, 3, 301):
        assert order(line_runs.drop_frequent_lines(docs, least).collect()) == dropped_lines(rows, least)


def test_batches_that_arrive_over_time(spark):
    folder = shared_dir(spark, "test-line-runs")
    batches = [[(10 * b + i, f"first {i}\nbatch {b}\nfoot") for i in range(3)] for b in range(5)]
    runs = line_runs.LineRuns(spark, folder, 3)
    before = []
    for at, rows in enumerate(batches):
        if at == 3:
            runs = line_runs.LineRuns.reopen(spark, folder)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = line_runs.admit(docs, runs, min_docs=4).collect()
        assert order(found) == dropped_lines(rows, 4, more=before)
        before += rows
    # Five batches in pairs: one run of four and one of one.
    assert sorted(level for _, level in runs.live) == [0, 2]
    total = {bytes(r["hash"]): r["n_docs"] for r in runs.totals().collect()}
    assert total[hashlib.sha256(b"foot").digest()[:16]] == 15 and len(total) == 3 + 5 + 1


def test_runs_merge_without_moving(spark):
    runs = line_runs.LineRuns(spark, shared_dir(spark, "test-line-runs"), 3, fan_in=3)
    for b in range(2):
        runs.add(spark.range(40).selectExpr(f"unhex(hex(id + {b})) AS hash"))
    plan = runs.totals()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_lines_native_plan(spark, small):
    plan = line_runs.drop_frequent_lines(small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_line_operator_on_empty_and_clashing_tables(spark, edge, empty):
    assert line_runs.drop_frequent_lines(empty).collect() == []
    assert order(line_runs.drop_frequent_lines(edge, 2).collect()) == dropped_lines(pairs_of(edge), 2)


# Cuts


def cut_of(i, text, unit, seed=42, cut=50, spm=80):
    text = text or ""
    pattern = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+" if unit == "token" else r"(?s)."
    units = re.findall(pattern, text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= cut:
        return (i, n, "plain", None, None, text)
    if h4 % 100 < spm:
        return (i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit, cut, spm", [("token", 50, 80), ("token", 100, 50), ("code point", 100, 50)])
def test_cuts(spark, small, edge, empty, unit, cut, spm):
    for docs in (small, edge, spark.createDataFrame(ODD, "doc_id bigint, text string")):
        found = fill_in_middle.fill_in_middle(docs, cut_percent=cut, spm_percent=spm, unit=unit)
        assert order(found.collect()) == order(cut_of(i, t, unit, cut=cut, spm=spm) for i, t in pairs_of(docs))
        back = found.select("doc_id", fill_in_middle.restored(found["output"], found["form"]))
        assert order(back.collect()) == order((i, t or "") for i, t in pairs_of(docs))
    assert fill_in_middle.fill_in_middle(empty, unit=unit).collect() == []


def test_boundary_set_of_each_kind():
    rng = np.random.default_rng(3)
    spans = [
        rng.random(fill_in_middle.SPAN) < 0.01, np.zeros(fill_in_middle.SPAN, bool), rng.random(fill_in_middle.SPAN) < 0.4,
        np.ones(fill_in_middle.SPAN, bool), np.arange(fill_in_middle.SPAN) % 5000 < 4000, rng.random(777) < 0.5,
    ]
    found = fill_in_middle.BoundarySet()
    for number, flags in enumerate(spans):
        found.append(number, flags)
    assert {kind for _, kind, _ in found.containers} == {0, 1, 2}
    whole = np.flatnonzero(np.concatenate(spans))
    assert len(found) == len(whole)
    for k in [0, 1, len(whole) - 1, *rng.integers(0, len(whole), 3000).tolist()]:
        assert found.select(k) == whole[k]


@pytest.mark.parametrize("length", [65535, 65536, 65537, 131072, 200_000])
def test_ends_at_the_border_of_a_container(length):
    rng = random.Random(length)
    for text in ("".join(rng.choice("ab \n") for _ in range(length)), "a" * length, " " * length, "é" * (length // 2)):
        data = np.frombuffer(text.encode(), np.uint8)
        ends = [m.end() - 1 for m in re.finditer(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", data.tobytes())]
        found = fill_in_middle.token_ends(data)
        assert len(found) == len(ends) and [found.select(k) for k in range(0, len(ends), 997)] == ends[::997]
        assert len(fill_in_middle.code_point_ends(data)) == len(text)


# Alignment


def by_hand(rows):
    """The operator's rows by the libraries and a walk over both token lists."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
    byte = {chr(letter): b for b, letter in tokens._byte_letters().items()}
    heads, links = [], []
    for i, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(byte[c] for c in a_model.id_to_token(k)) for k in a]
        names = [b_model.id_to_piece(k) for k in b]
        b_bytes = [bytes([int(x[3:5], 16)]) if b_model.is_byte(k) else x.replace("▁", " ").encode() for x, k in zip(names, b, strict=True)]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            heads.append((i, 0, 0, 0, 0, ""))
            links.append([])
            continue
        a_of = [k for k, x in enumerate(a_bytes) for _ in x]
        b_of = [k for k, x in enumerate(b_bytes) for _ in x]
        overlaps = list(dict.fromkeys(zip(a_of, b_of, strict=True)))
        groups, at_a, at_b = [], 0, 0
        for p, (x, y) in enumerate(zip(a_of, b_of, strict=True)):
            last = p + 1 == len(a_of)
            if last or (a_of[p + 1] != x and b_of[p + 1] != y):
                groups.append(",".join(map(str, a[at_a : x + 1])) + "|" + ",".join(map(str, b[at_b : y + 1])))
                at_a, at_b = x + 1, y + 1
        heads.append((i, len(a), len(b), len(groups), len(overlaps), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append([(a[x], b[y]) for x, y in overlaps])
    counts = collections.Counter(pair for each in links for pair in set(each))
    best: dict = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return order(
        (*h[:5], sum(counts[p] == best[p[0]] for p in each), sum(counts[p] for p in each), h[5]) for h, each in zip(heads, links, strict=True)
    )


def aligned_rows(docs, **options):
    return order(alignment.align_tokenizers(docs, tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE), **options).collect())


@pytest.mark.parametrize("frequent", [0, 30, alignment.FREQUENT_PAIRS])
def test_alignment(spark, small, edge, frequent):
    odd = spark.createDataFrame(EDGE_TEXTS + ODD, "doc_id bigint, text string").repartition(4)
    for docs in (small, odd, edge):
        assert aligned_rows(docs, frequent=frequent) == by_hand(pairs_of(docs))


def test_alignment_of_nothing(spark, empty):
    assert aligned_rows(empty) == []
    docs = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id bigint, text string")
    assert aligned_rows(docs) == by_hand([(1, None), (2, ""), (None, None)])


def test_parts_give_the_models_ids():
    model = alignment.Pieces(tokenizer_path(PIECE_BPE))
    assert model.part is not None
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "the", " ", "  ", "\n", "\t", "é", "漢", "ing", ".", "<s>", "0", "\r\n", "▁", "\x00"]) for _ in range(rng.randint(1, 30)))
        assert list(np.frombuffer(model.ids(text), "<u4")) == model.model.encode(text)


def test_chunks_give_the_ids_of_both(monkeypatch):
    """One look-up per chunk gives the ids of both; runs of known chunks are encoded by neither."""
    monkeypatch.setattr(alignment, "KEPT", 500)
    both = alignment.Both(tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE))
    rng = random.Random(6)
    letters = ["a", "the", " ", " ", "  ", "\n", "\t", "é", "漢", "ing", ".", "<s>", "0", "\r\n", "▁", "\x00", "\x1c", "\u2003", "'s"]
    for _ in range(60):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(50)]
        raw = [f" {t}".encode() for t in texts]
        a = [np.frombuffer(both.a.ids(" " + t) if t else b"", "<u4") for t in texts]
        b = [np.array(both.b.model.encode(t) if t else [], "<u4") for t in texts]
        fine = [alignment._joined_equal(both.a.bytes, x, r) and alignment._joined_equal(both.b.bytes, y, r) for x, y, r in zip(a, b, raw, strict=True)]
        a, b = ([x if ok else x[:0] for x, ok in zip(ids, fine, strict=True)] for ids in (a, b))
        found = both.ids(texts)
        for got, want in zip(found, ([*map(len, a)], [*map(len, b)], np.concatenate(a), np.concatenate(b)), strict=True):
            assert got.tolist() == list(want)
    known = ["one two,  three\n four", "two,\n\tfive "]
    first = both.ids(known)
    monkeypatch.setattr(both, "_encode", lambda chunks: {}[chunks[0]] if chunks else {})
    assert all((x == y).all() for x, y in zip(both.ids(known), first, strict=True))


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_give_the_same_overlaps(steps):
    rng = np.random.default_rng(steps)
    for _ in range(50):
        total = int(rng.integers(2, 80))
        a, b = (np.append(np.flatnonzero(rng.random(total - 1) < share) + 1, total) for share in rng.random(2))
        a_of, b_of = (np.searchsorted(x, np.arange(total), side="right") for x in (a, b))
        links = list(dict.fromkeys(zip(a_of.tolist(), b_of.tolist(), strict=True)))
        a_at, b_at, a_last, b_last = alignment.merge_pieces(a, b, steps)
        assert list(zip(a_at.tolist(), b_at.tolist(), strict=True)) == links
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[a_last].tolist() == shared == b[b_last].tolist()
        cuts = [alignment.diagonal(a, b, d) for d in range(0, len(a) + len(b), steps)]
        assert all(0 <= i + j - d <= 1 for d, (i, j) in zip(range(0, len(a) + len(b), steps), cuts, strict=True))
