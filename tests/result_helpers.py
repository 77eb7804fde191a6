"""Rows and plans of results. A module of its own name: ``conftest`` may be another folder's."""


def rows(df):
    return [tuple(row) for row in df.collect()]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
