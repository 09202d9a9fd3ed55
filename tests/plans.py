"""Plan text for tests."""


def text_plan(df):
    """The executed plan: the one chosen before the run."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution; runs the query."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()
