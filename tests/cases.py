"""Helpers of the tests."""

SF_DIR = "/root/testdata/sf0.01"


def rows_of(df, *columns):
    names = columns or df.columns
    return sorted((tuple(row[c] for c in names) for row in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
