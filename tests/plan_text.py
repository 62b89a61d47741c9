"""The physical plan of a frame, as text."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
