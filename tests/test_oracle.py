"""Every query against its SQL twin in DuckDB, over whole tables."""

import duckdb
import pytest
from cases import SF_DIR, plan_of

from tideline.sample import catalog, oracle

QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _text(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    return "~" if value is None else str(value)


def _sorted(rows, names, wanted):
    order = [names.index(w) for w in wanted]
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    found = df.collect()
    assert found, "a query without rows checks nothing"
    if name not in ORACLE:
        return
    relation = duck.execute(ORACLE[name])
    names = [d[0] for d in relation.description]
    wanted = sorted(df.columns)
    assert sorted(names) == wanted
    assert _sorted(found, df.columns, wanted) == _sorted(relation.fetchall(), names, wanted)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {
        "stream_trailing_engagement", "trailing_engagement_nested_approx",
    }


def test_approximate_counts_are_close(spark):
    exact = QUERIES["trailing_engagement_nested_exact"](spark, SF_DIR).toPandas().set_index("corpus_recommendation_id")
    approx = QUERIES["trailing_engagement_nested_approx"](spark, SF_DIR).toPandas().set_index("corpus_recommendation_id")
    both = exact.join(approx, rsuffix="_approx")
    for column in ("trailing_1_day_impressions", "trailing_1_day_opens"):
        difference = (both[column] - both[f"{column}_approx"]).abs()
        assert (difference <= 1 + 0.15 * both[column]).all()
    assert (both["updated_at"] == both["updated_at_approx"]).all()
