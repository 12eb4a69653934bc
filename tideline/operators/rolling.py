"""Rolling sums over daily totals.

Input is one row per key and day, so a key has at most one row per calendar
day however many events it had: reduce first, then window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_totals(df: DataFrame, keys: Sequence[str], time: str, day: str, **measures: Column) -> DataFrame:
    return df.groupBy(*keys, F.to_date(time).alias(day)).agg(*[m.alias(name) for name, m in measures.items()])


def rolling_days(
    daily: DataFrame, keys: Sequence[str], day: str, days: int, sums: Mapping[str, str]
) -> DataFrame:
    """Sums over the last ``days`` calendar days, gaps included: ``{new name: column}``."""
    window = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)
    return daily.withColumns({name: F.sum(column).over(window) for name, column in sums.items()})


def rolling_rows(
    daily: DataFrame, keys: Sequence[str], day: str, rows: int, sums: Mapping[str, str]
) -> DataFrame:
    """Sums over the last ``rows`` stored days. With gaps this spans more calendar time."""
    window = Window.partitionBy(*keys).orderBy(day).rowsBetween(-(rows - 1), 0)
    return daily.withColumns({name: F.sum(column).over(window) for name, column in sums.items()})
