import numpy as np
import pytest
from llm_cases import SMALL
from pyspark.sql import functions as F

from tideline.llm import neighbours


def exact(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero([asked(i) for i in ids]):
        score = x @ x[q]
        order = [j for j in np.lexsort((ids, -np.round(score, 9))) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [int(ids[j]) for j in order]
    return out


def found_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    wanted = exact([(r["vec_id"], r["embedding"]) for r in vectors.collect()], lambda i: i % 20 == 0, 20)
    found = found_of(neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0))
    assert found.keys() == wanted.keys() and all(len(v) == 20 for v in found.values())
    assert np.mean([len({*found[q]} & {*wanted[q]}) / 20 for q in wanted]) >= 0.95


@pytest.mark.parametrize("leaf", [40, 2048])
def test_norms_copies_and_bad_vectors(spark, leaf, monkeypatch):
    """Different lengths of vectors, many copies, and rows that take no part."""
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    draw = np.random.default_rng(2)
    rows = [(i, (draw.standard_normal(8) * draw.uniform(0.2, 3)).round(3).tolist()) for i in range(400)]
    rows += [(400 + i, rows[20][1]) for i in range(150)]
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [None] + [1.0] * 7), (1060, [float("nan")] * 8), (1080, [float("inf")] * 8), (None, [1.0] * 8), (1100, [1.0] * 3), (1120, [])]
    vectors = spark.createDataFrame([(i, v, "x", 1.0, 5) for i, v in rows + bad], "vec_id bigint, embedding array<double>, id string, score double, src int")
    wanted = exact(rows, lambda i: i % 20 == 0, 20)
    found = found_of(neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0))
    assert found.keys() == wanted.keys() and all(len(v) == 20 for v in found.values())
    assert np.mean([len({*found[q]} & {*wanted[q]}) / 20 for q in wanted]) >= 0.9
    assert found[20][:3] == wanted[20][:3]


def test_few_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], schema)
    rows = neighbours.nearest_neighbours(three, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in rows] == [(1, 1, 1.0), (2, 2, 0.0)]
    one = spark.createDataFrame([(0, [1.0, 0.0])], schema)
    assert neighbours.nearest_neighbours(one, F.col("vec_id") == 0).collect() == []
    assert neighbours.nearest_neighbours(one.limit(0), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("shape", ["outlier", "lengths", "clusters"])
def test_recall_where_one_scale_fails(spark, shape):
    """One vector of norm 100 among unit ones, log-normal norms, and clusters of 1,000 near copies."""
    draw = np.random.default_rng(5)
    x = draw.standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if shape == "outlier":
        x[7] *= 100
    elif shape == "lengths":
        x *= np.exp(draw.standard_normal(len(x)))[:, None]
    else:
        x = np.repeat(x[:6], 1000, axis=0) + 0.001 * draw.standard_normal(x.shape)
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    found = found_of(neighbours.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0))
    recall = []
    for q in range(0, len(x), 100):
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len({*found[q]} & {*np.argsort(-score)[:20].tolist()}) / 20)
    assert np.mean(recall) >= 0.95


def test_no_part_of_a_leaf_is_large(spark, monkeypatch):
    """Near copies fall on the same side of every plane: their leaf is dealt by its own size, others stay whole."""
    monkeypatch.setattr(neighbours, "LEAF", 100)
    draw = np.random.default_rng(3)
    x = np.concatenate([np.ones((3000, 16)) + 1e-12 * draw.standard_normal((3000, 16)), draw.standard_normal((1000, 16))])
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    parts = []
    whole = neighbours._dealt

    def dealt(exploded):
        found = whole(exploded)
        parts.extend(found.groupBy("tree", "leaf", "deal").count().collect())
        return found

    monkeypatch.setattr(neighbours, "_dealt", dealt)
    assert neighbours.build(vectors).n == 4000
    leaves = {}
    for r in parts:
        leaves[r["tree"], r["leaf"]] = leaves.get((r["tree"], r["leaf"]), 0) + r["count"]
    assert sum(leaves.values()) == (neighbours.TREES + neighbours.DEALS) * 4000 and max(leaves.values()) >= 1000
    # Twice LEAF on average over the parts of a leaf, with room for the hash.
    assert max(r["count"] for r in parts) <= 300
    assert {r["leaf"] for r in parts if r["deal"]} != {r["leaf"] for r in parts}


@pytest.mark.parametrize("scale, first, size", [(1.0, 1e160, 16), (1e-150, 1.0, 16), (1e150, 1.0, 16), (1.0, 1.0, 1024)])
def test_extreme_components_and_long_vectors(spark, scale, first, size):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1200, size))
    x[0, 0] *= first
    docs = spark.createDataFrame([(i, (v * scale).tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = found_of(neighbours.nearest_neighbours(docs, F.col("vec_id") % 40 == 0))
    recall = []
    for q in range(40, 1200, 40):
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len({*found[q]} & {*np.argsort(-score)[:20].tolist()}) / 20)
    assert np.mean(recall) >= 0.95 and len(found[0]) == 20


def test_walks_do_not_stay_in_patches(spark, monkeypatch):
    """Many small leaves, few links: deals at random and rounds until still lead out of them."""
    monkeypatch.setattr(neighbours, "LEAF", 100)
    x = np.random.default_rng(6).standard_normal((12_000, 32))
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = found_of(neighbours.nearest_neighbours(docs, F.col("vec_id") % 200 == 0))
    recall = []
    for q in range(0, 12_000, 200):
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len({*found[q]} & {*np.argsort(-score)[:20].tolist()}) / 20)
    assert np.mean(recall) >= 0.95


def test_no_row_for_a_link_or_a_vector_met(spark, monkeypatch):
    """What is moved are arrays from block to block: no step writes more rows than there are vectors."""
    rows = {}
    whole = neighbours.written

    def written(df, name):
        found = whole(df, name)
        rows[name] = max(rows.get(name, 0), found.count())
        return found

    monkeypatch.setattr(neighbours, "written", written)
    x = np.random.default_rng(8).standard_normal((3000, 16))
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = found_of(neighbours.nearest_neighbours(docs, F.col("vec_id") % 100 == 0))
    assert len(found) == 30 and {"nn-edges", "nn-links", "nn-walk"} <= rows.keys()
    assert max(rows.values()) <= 3000, rows
