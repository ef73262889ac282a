"""The pipeline against a version without Spark, on the smallest tables."""

import numpy as np
from llm_cases import SMALL, near_classes, removed_bytes, repeats_of, texts_of
from test_tokens import check_packed, library

import corpus_pipeline
from tideline.llm import curriculum
from tideline.llm.queries import WORD_BPE


def test_stages(spark, small):
    docs = small
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = texts_of(docs)
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        assert docs.columns == small.columns
        after = texts_of(docs)
        if name == "quality_rules":
            wanted = []
            for i, t in before:
                words = (t or "").encode().split()
                covered, longest = repeats_of(words)
                if len(words) >= 10 and 100 * covered <= 20 * len(words) and longest <= 64:
                    wanted.append((i, t))
            assert after == wanted and 0 < len(wanted) < len(before)
        elif name == "near_duplicates":
            classes = near_classes(before)
            assert after == [(i, t) for i, t in before if classes[i] == i] and len(after) < len(before)
        elif name == "suffix_dedup":
            wanted = [
                (i, np.frombuffer(data, np.uint8)[~mask].tobytes().decode(errors="ignore") if len(data) else t)
                for (i, data, mask), (_, t) in zip(removed_bytes(before), before, strict=True)
            ]
            assert after == wanted and after != before
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
            sized = {r["doc_id"]: r["passes"] for r in curriculum.curriculum(docs).collect()}
        else:
            assert after == sorted((i, t) for i, t in before for _ in range(sized[i]))
    whole = library(WORD_BPE)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packed(rows, [(i, [*whole(t), 0]) for i, t in texts_of(docs)], 2048)


def test_run_gives_the_stages_rows(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "suffix_dedup", "mixing", "packing"]
