import collections
import hashlib
import math
import random
import struct

import duckdb
import numpy as np
import pytest
import xxhash
from llm_cases import SMALL, bag_of, near_classes, removed_bytes, repeats_of, texts_of
from pyspark.sql import functions as F

from tideline.llm import bagminhash, components, curriculum, language, queries, repetition, resampling, suffixes


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    relation = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in relation.description]
    found = queries.queries()[name](spark, SMALL)
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(relation.fetchall())


def test_repeats_by_brute_force():
    draw = random.Random(3)
    for _ in range(150):
        words = [draw.choice([b"a", b"b", b"c"][: draw.randint(1, 3)]) for _ in range(draw.randint(0, 60))]
        starts, lengths = repetition.repeat_spans(words)
        found = repetition.covered(starts, lengths, len(words)), int(lengths.max(initial=0))
        assert found == repeats_of(words)


def test_quality_rules(edge, empty):
    rows = repetition.quality_rules(edge).collect()
    assert len(rows) == edge.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for i in (1, 2, 3):
        assert by_id[i]["n_words"] == 0 and by_id[i]["base_failed"] and not by_id[i]["kept"]
    assert by_id[5]["n_words"] == 10 and by_id[5]["kept"] and by_id[7]["kept"]
    assert by_id[9]["n_repeat_words"] == 400 and by_id[9]["longest_repeat"] == 399 and not by_id[9]["kept"]
    # One long repeat in a text that is long enough to pass by its share.
    long = [str(i) for i in range(1000)]
    assert not repetition._verdicts([" ".join(long + long[:70])])[2][0]
    assert repetition._verdicts([" ".join(long + long[:60])])[2][0]
    assert repetition.quality_rules(empty).collect() == [] and repetition.accepted(empty).collect() == []
    assert repetition.accepted(edge).columns == edge.columns


def test_near_duplicates(spark, edge, empty, small):
    for docs in (edge, small):
        found = bagminhash.near_duplicates(docs).collect()
        assert len(found) == docs.count()
        assert {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None} == near_classes(texts_of(docs))
        assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)
    assert bagminhash.near_duplicates(empty).collect() == []
    kept = bagminhash.deduplicated(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] or -1 for r in kept.select("doc_id").collect()) == [-1, 1, 2, 3, 4, 5, 7, 8, 9, 10]


@pytest.mark.parametrize("turn", [1, -1])
@pytest.mark.parametrize("rounds", [1, 2])
def test_every_text_of_an_id_links_it(spark, monkeypatch, turn, rounds):
    """Ids that stand on two texts each, and a chain that only all of them together close."""
    monkeypatch.setattr(bagminhash, "STAR_ROUNDS", rounds)
    texts = [" ".join(f"t{k}w{i}" for i in range(100)) for k in range(5)]
    near = [t.replace("w50", "v50") for t in texts]
    rows = [(6, texts[0]), (6, texts[1]), (9, near[0]), (8, near[1]), (8, texts[2]), (12, near[2]), (13, texts[3]), (13, texts[3]), (14, texts[4])]
    docs = spark.createDataFrame(rows[::turn], "doc_id bigint, text string").repartition(2)
    found = bagminhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in found} == near_classes(rows) == {6: 6, 9: 6, 8: 6, 12: 6, 13: 13, 14: 14}


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_large_groups_of_near_copies(spark, monkeypatch, rounds):
    """Chains of copies that are near to some of the group only, in buckets of several blocks."""
    monkeypatch.setattr(bagminhash, "BLOCK", 8)
    monkeypatch.setattr(bagminhash, "STAR_ROUNDS", rounds)
    draw = random.Random(9)
    rows = []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(120)]
        for _ in range(40):
            words = list(base)
            for _ in range(draw.randint(1, 3)):
                words[draw.randrange(120)] = f"new{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    draw.shuffle(rows)
    found = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == near_classes(rows)


def test_signatures_estimate_the_weighted_similarity():
    """Unbiased: over many pairs the share of equal components is the similarity of the bags."""
    draw = np.random.default_rng(4)
    pairs = []
    for _ in range(60):
        a = np.repeat(draw.integers(1, 1 << 50, 30).astype(np.uint64), draw.integers(1, 9, 30))
        b = np.concatenate([a[draw.random(len(a)) < 0.8], draw.integers(1, 1 << 50, 10).astype(np.uint64)])
        pairs.append((a, b))
    made = bagminhash.signatures([x for p in pairs for x in p])
    equal = (made[::2] == made[1::2]).mean(axis=1)
    real = []
    for a, b in pairs:
        (ka, na), (kb, nb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
        _, i, j = np.intersect1d(ka, kb, return_indices=True)
        common = np.minimum(na[i], nb[j]).sum()
        real.append(common / (len(a) + len(b) - common))
    assert abs(equal.mean() - np.mean(real)) < 0.01
    assert np.abs(equal - real).max() < 0.16


def test_bag_of_library_and_test_agree():
    a, b = "a b c d e f g a b c d e", "a b c d e f g h"
    keys, counts = bagminhash.bag(a)
    assert sorted(counts) == sorted(bag_of(a).values()) and len(bagminhash.bag(b)[0]) == 4


def test_components(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(100, 150)] + [(draw.randrange(60), draw.randrange(60)) for _ in range(40)]
    links += [(200, 200 + i) for i in range(1, 50)] + [(7, 7)]
    parent = {i: i for pair in links for i in pair}
    for _ in parent:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["id"]: r["label"] for r in found} == {i: p for i, p in parent.items() if i != p}


def check_repeats(docs, **options):
    wanted = []
    for i, data, mask in removed_bytes(texts_of(docs)):
        rest = np.frombuffer(data, np.uint8)[~mask].tobytes()
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        wanted.append((i if i is not None else -1, len(data), int(mask.sum()), spans, hashlib.sha256(rest).hexdigest()))
    found = suffixes.remove_repeats(docs, **options).collect()
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in found) == sorted(wanted)
    return sum(w[2] for w in wanted)


@pytest.mark.parametrize("block_bytes", [3000, 40_000, 6 << 20])
def test_repeated_strings(spark, edge, small, block_bytes, monkeypatch):
    monkeypatch.setattr(suffixes, "PART_BYTES", 50_000)
    extra = edge.select("doc_id", "text").union(edge.select((F.col("doc_id") + 1000).alias("doc_id"), F.concat(F.lit("é"), "text").alias("text")))
    for docs in (small, extra):
        check_repeats(docs, block_bytes=block_bytes)


@pytest.mark.parametrize("name_bits, whole_bytes", [(8, False), (8, True), (20, True), (64, False)])
@pytest.mark.parametrize("block_bytes", [2000, 1 << 20])
def test_bytes_decide_on_repeats(spark, name_bits, whole_bytes, block_bytes, monkeypatch):
    """Names of a few bits, a hot string of 25 bytes in many contexts, passages cut at both ends, ids that repeat."""
    monkeypatch.setattr(suffixes, "PART_BYTES", 4000)
    draw = random.Random(50)
    letters = "abcdefgh "
    hot = "a hot string of 25 bytes."
    passages = ["".join(draw.choices(letters, k=200)) for _ in range(4)]
    rows = []
    for i in range(120):
        text = "".join(draw.choices(letters, k=draw.randrange(120))) + hot + "".join(draw.choices(letters, k=30)) + hot
        for _ in range(draw.randrange(3)):
            passage, start = draw.choice(passages), draw.randrange(150)
            text += passage[start : start + draw.randrange(30, 120)] + "".join(draw.choices(letters, k=draw.randrange(9)))
        rows.append((i // 2 if i < 20 else i, text))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert check_repeats(docs, block_bytes=block_bytes, name_bits=name_bits, whole_bytes=whole_bytes) > 0


def test_bytes_are_read_of_names_that_recur():
    draw = np.random.default_rng(3)
    for top in (1, 4, 300, 1 << 60):
        keys = draw.integers(0, top, 500).astype(np.uint64), draw.integers(0, 3, 500).astype(np.uint64)
        rows = np.stack(keys, axis=1)
        asked = []
        order, number = suffixes._exact_firsts(lambda i: (asked.extend(i.tolist()), rows[i])[1], *keys)
        assert order.tolist() == np.lexsort(keys[::-1]).tolist()
        names = [tuple(x) for x in rows[order].tolist()]
        assert number.tolist() == [sorted(set(names)).index(x) for x in names]
        assert all(names.count(tuple(rows[i].tolist())) > 1 for i in asked)
    assert [len(x) for x in suffixes._exact_firsts(None, keys[0][:0])] == [0, 0]


@pytest.mark.parametrize("stride", [64, 1000])
def test_stretches_hold_every_window_once(stride, monkeypatch):
    monkeypatch.setattr(suffixes, "STRIDE", stride)
    draw = random.Random(7)
    sizes = [0, 49, 50, 51, 0, 300, 3, 2000, 128, 64, 10, 51, 0]
    rows = [(i, bytes(draw.choices(b"ab ", k=n))) for i, n in enumerate(sizes)]
    block = suffixes.Block(rows, 1, 64, False)
    windows = [p for low, high in zip(block.low.tolist(), block.high.tolist(), strict=True) for p in range(low, high + 1)]
    starts = np.cumsum([0, *sizes]).tolist()
    assert windows == [at + p for at, n in zip(starts, sizes, strict=False) for p in range(n - 49)]
    assert block.rank.tolist() == [next(i for i, n in enumerate(sizes) if starts[i] <= p < starts[i] + n) for p in block.low.tolist()]


def test_texts_without_repeats(edge, empty):
    found = suffixes.without_repeats(edge)
    assert found.columns == edge.columns and found.count() == edge.count()
    assert {r["doc_id"]: r["text"] for r in found.collect()}[1] is None
    assert suffixes.without_repeats(empty).collect() == [] and suffixes.remove_repeats(empty).collect() == []


def shared_out(sizes, weights, share, passes):
    """Targets by filling and sharing out again what the caps leave."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, free = share * sum(sizes.values()), set(names)
    while free and left > 1e-9:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > passes * sizes[s]}
        for s in full or free:
            target[s] = passes * sizes[s] if full else level * weight[s]
            left -= target[s]
        free = free - full if full else set()
    return target


def test_mixing(spark, edge, empty, small):
    for docs in (edge, small, small.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").otherwise(F.col("source")))):
        rows = curriculum.curriculum(docs).collect()
        assert len(rows) == docs.count()
        sizes, taken, largest = {}, {}, {}
        for r in rows:
            s = r["source"]
            sizes[s] = sizes.get(s, 0) + r["size"]
            taken[s] = taken.get(s, 0) + r["taken"]
            largest[s] = max(largest.get(s, 0), r["size"])
            assert r["taken"] in (0, r["size"], 2 * r["size"])
        target = shared_out(sizes, curriculum.WEIGHTS, 1.5, 2)
        for s in sizes:
            assert {r["source_size"] for r in rows if r["source"] == s} == {sizes[s]}
            assert all(abs(r["target"] - target[s]) < 1e-6 for r in rows if r["source"] == s)
            assert abs(taken[s] - target[s]) <= largest[s]
        again = curriculum.curriculum(docs).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
    assert curriculum.curriculum(empty).collect() == [] and curriculum.mixed_rows(empty).collect() == []
    assert "Python" not in curriculum.mixed_rows(small)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_rows_that_share_an_id_are_mixed_by_their_own_positions(spark):
    """The heavy source is taken twice, the light one in part; ids do not tell their rows apart."""
    words = " ".join(["w"] * 10)
    rows = [(1, "a", words), (1, "z", words), (1, "z", words + " x")] + [(k, "z", words) for k in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    key = lambda r: (r["doc_id"], r["source"], len(r["text"].split()))
    mixed = collections.Counter(map(key, curriculum.mixed_rows(docs, weights=(1,), share=0.5).collect()))
    wanted = {}
    for r in curriculum.curriculum(docs, weights=(1,), share=0.5).collect():
        assert r["taken"] == r["size"] * len(r["positions"]) and r["position"] == next(iter(r["positions"]), None)
        wanted[r["doc_id"], r["source"], r["size"]] = r["passes"]
    assert wanted[1, "a", 10] == 2 and 0 in wanted.values() and 1 in wanted.values()
    assert mixed == {k: n for k, n in wanted.items() if n}


def test_the_query_sorts_by_position_without_python(spark):
    plan = queries.op8_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "rangepartitioning(position" in plan and "SQRT" in plan.upper() and "Python" not in plan


def test_mixed_documents_follow_their_schedules(small):
    rows = curriculum.mixed_documents(small).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert all(0 <= r["position"] <= 1 for r in rows)
    taken = {r["doc_id"]: r["passes"] for r in curriculum.curriculum(small).collect()}
    assert len(rows) == sum(taken.values()) == curriculum.mixed_rows(small).count()
    # Words of a source up to half time: the integral of its density, 1/2 + slope * (1/4 - 1/2).
    sources = sorted({r["source"] for r in rows})
    for k, s in enumerate(sources[:3]):
        total = sum(r["size"] for r in rows if r["source"] == s)
        early = sum(r["size"] for r in rows if r["source"] == s and r["position"] <= 0.5)
        biggest = max(r["size"] for r in rows if r["source"] == s)
        assert abs(early / total - (0.5 - curriculum.SLOPES[k % 3] / 4)) <= 2 * biggest / total + 0.02


def test_languages(spark, edge, empty, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.97 * len(found) > 0
    rows = {r["doc_id"]: r for r in language.identify_held_out(edge).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == rows[3]["lang_pred"] == "und" and rows[1]["score"] == 0
    assert rows[5]["lang_pred"] in ("en", "de") and 0 <= rows[5]["score"] <= 1
    assert language.identify_held_out(empty).collect() == []
    none = language.identify_held_out(edge.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_texts_far_from_training_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang = 'en'")
    model = language.train(docs, F.lit(True))
    names, score, far = model.predict(["zqxj vkwz qqxz jjkv xzqk wvzx " * 20, docs.first()["text"]])
    assert far[0] and not far[1] and score[0] < score[1]


def test_languages_by_plain_comparison(spark, small):
    """Every prediction is the language of the centroid with the largest cosine, computed gram by gram."""
    model = language.train(small, F.lit(True))
    rows = {r["doc_id"]: r for r in language.identify(small, model).collect()}
    for r in small.limit(40).collect():
        weight = collections.Counter()
        raw = r["text"].encode().lower()
        for at, count in enumerate(language.gram_counts([r["text"]])[0].tolist()):
            if count:
                weight[at] = math.log1p(count) * model.idf[at]
        assert sum(language.gram_counts([r["text"]])[0]) == sum(max(0, len(raw) - n + 1) for n in (1, 2, 3))
        norm = math.sqrt(sum(w * w for w in weight.values()))
        cosine = [sum(w * c[at] for at, w in weight.items()) / norm for c in model.centres]
        best = max(range(len(cosine)), key=cosine.__getitem__)
        assert rows[r["doc_id"]]["lang_pred"] == model.languages[best]
        assert rows[r["doc_id"]]["score"] == pytest.approx(cosine[best], abs=1e-4)


def test_no_language_is_lost(spark, monkeypatch):
    """Three thousand labels, and one language with nearly all rows."""
    many = spark.range(3000).selectExpr("id AS doc_id", "concat('lang', id) AS lang", "concat('text of language ', id) AS text")
    assert len(set(language.train(many, F.lit(True)).languages)) == 3000
    monkeypatch.setattr(language, "SAMPLE_TEXTS", 6)
    skewed = spark.range(20_000).selectExpr("id AS doc_id", "IF(id = 7, 'rare', 'frequent') AS lang", "concat('words ', id) AS text")
    assert set(language.train(skewed, F.lit(True)).languages) == {"rare", "frequent"}
    silent = skewed.union(spark.createDataFrame([(-i, "late", None if i == 1 else "." * i) for i in range(1, 9)] + [(-9, "late", "abc")], "doc_id bigint, lang string, text string"))
    assert "late" in language.train(silent, F.lit(True)).languages


def test_resampling_by_plain_counts(spark):
    """Models, weights, Gumbel keys and the kept set, plainly; a bounded sample would not reach these tables."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    given = labels.collect()
    good = {r["doc_id"] for r in given if r["quality"] == 1}
    raw, target = np.zeros(resampling.BUCKETS), np.zeros(resampling.BUCKETS)
    for i, text in texts:
        for gram in resampling.hashed_grams(text):
            raw[gram] += 1
            target[gram] += i in good
    ratio = np.log((target + 1) / (target.sum() + resampling.BUCKETS)) - np.log((raw + 1) / (raw.sum() + resampling.BUCKETS))
    keys = {}
    for i, text in texts:
        digest = xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
        digest = xxhash.xxh64_intdigest(struct.pack("<i", 0), digest)
        uniform = ((digest >> 11) + 0.5) / 2**53
        keys[i] = (sum(ratio[g] for g in resampling.hashed_grams(text)) - math.log(-math.log(uniform)), i)
    share = np.mean([r["quality"] for r in given if r["quality"] is not None])
    wanted = {i for _, i in sorted(keys.values(), reverse=True)[: round(share * len(texts))]}
    rows = resampling.importance_resample(docs, labels).collect()
    assert {r["doc_id"] for r in rows if r["kept"]} == wanted and len(rows) == len(texts)


def test_resampling_with_its_own_names_and_tied_keys(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b", 1, 2), (2, None, 3, 4)], "doc_id bigint, text string, _good int, good int")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    assert resampling.importance_resample(docs, labels).count() == 2
    monkeypatch.setattr(resampling, "BAND", 10)
    values = [1.0] * 500 + [2.0] * 500 + [1.5]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 500, 501, 502, 1001):
        assert resampling.kth_key(keys, k) == sorted(values, reverse=True)[k - 1]


def test_resampling(spark, edge, empty, small, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = resampling.importance_resample(docs, labels).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.5
    assert resampling.importance_resample(docs, labels, 0.25).filter("kept").count() in range(250, 260)
    no_labels = labels.limit(0)
    assert resampling.importance_resample(edge, no_labels).filter("kept").count() == edge.count()
    assert resampling.importance_resample(edge, labels, 0.0).filter("kept").count() == 0
    assert resampling.importance_resample(empty, labels).collect() == []
    monkeypatch.setattr(resampling, "BAND", 20)
    values = [float(v) for v in np.random.default_rng(0).integers(0, 300, 900)] + [5.0] * 400
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 13, 700, 1100, 1300):
        assert resampling.kth_key(keys, k) == sorted(values, reverse=True)[k - 1]
