from collections import Counter


def rows(df, *columns):
    """Rows as a sorted list of tuples; missing values sort first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def bag(df, columns=None):
    names = columns or sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*names).collect())


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run(df):
    """Execute this very plan, so that its adaptive form becomes final."""
    return len(df.collect())
