"""The physical plan of a DataFrame as text. Not in conftest.py, of which several folders have one."""


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
