"""Shared assertions."""


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
