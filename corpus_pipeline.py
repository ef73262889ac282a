"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before it wrote; all but the last return the columns of
``documents``. SQL cannot express the stages, so a brute-force version checks them in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import bagminhash, curriculum, packing, repetition, suffixes
from tideline.llm.common import table, written
from tideline.llm.queries import WORD_BPE, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return repetition.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return bagminhash.deduplicated(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents hold."""
    return suffixes.without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by training position."""
    return curriculum.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    return packing.pack_documents(docs, tokenizer_path(WORD_BPE))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", repeats),
    ("mixing", mixing),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
