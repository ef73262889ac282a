import pytest
from llm_cases import CLASHING, EDGE_TEXTS, SMALL


@pytest.fixture(scope="session")
def edge(spark):
    """Awkward rows, with columns named as the operators' own."""
    langs = ["en", None, "de"]
    rows = [
        (i, t, langs[k % 3], [None, "b", "a"][k % 3], len(t or ""), 1, True, "x", "y", "z", "w", "v", 3)
        for k, (i, t) in enumerate(EDGE_TEXTS)
    ]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], CLASHING)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
