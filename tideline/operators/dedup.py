"""Deduplication with a repeatable survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``newest_first``.

    End the list with a unique tiebreak. Spark turns the rank filter into a
    group limit on both sides of the shuffle, so a map task sends at most one
    row per key, however many copies a hot key has.
    """
    return top_per_key(df, keys, newest_first, 1, _RANK).drop(_RANK)


def top_per_key(
    df: DataFrame, keys: Sequence[str], largest_first: Sequence[str], n: int, rank: str = "rank",
    then: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` rows of each key with their rank; ``then`` breaks ties ascending."""
    order = [F.col(c).desc() for c in largest_first] + [F.col(c).asc() for c in then]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def one_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str] = ()) -> DataFrame:
    """Drop duplicates on ``keys``; ties end on every remaining column.

    Exact copies leave one of them. Rows that share a key but differ leave the
    same survivor on every run, which ``dropDuplicates`` does not promise.
    """
    taken = {*keys, *newest_first}
    rest = [f.name for f in df.schema if f.name not in taken and not isinstance(f.dataType, T.MapType)]
    return latest_per_key(df, keys, [*newest_first, *rest])
