"""Helpers of the tests; a module of its own, because every folder's ``conftest`` has the same name."""

from datetime import datetime


def rows(df, *columns):
    """Rows as sorted tuples, optionally of some columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def at(text):
    """Zone-less time column value."""
    return datetime.fromisoformat(text)
