"""Partition layout and its report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import position


def by_count(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def merge_down(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle."""
    return df.coalesce(n)


def by_keys(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """Hash on a composite key: adding a second key spreads a hot first one."""
    return df.repartition(n, *keys)


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Group rows by ``keys`` in partitions of the advisory size.

    The adaptive planner splits a key that is too big for one partition and
    joins small ones, so one hot date does not become one task or one file.
    """
    return df.hint("rebalance", *keys)


def clustered(df: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """Range layout on ``keys``, sorted inside, so file footers prune.

    The row hash closes the range key: a value that fills several partitions is
    split between them instead of going to one. Without ``n`` the adaptive
    planner sizes the partitions.
    """
    spread = "__spread"
    ranges = [*keys, spread] if n is None else [n, *keys, spread]
    return (
        df.withColumn(spread, F.xxhash64(*df.columns))
        .repartitionByRange(*ranges)
        .drop(spread)
        .sortWithinPartitions(*keys)
    )


#: Bits of a column's place on the curve: 256 steps, each with about as many rows.
CURVE_BITS = 8


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column; of a text its first six bytes, which keep most of the order."""
    if isinstance(df.schema[column].dataType, (T.StringType, T.BinaryType)):
        return F.conv(F.hex(F.rpad(F.substring(F.col(column).cast("binary"), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    return position(df, column)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _rank(value: Column, bounds: list[float], bits: int) -> Column:
    """How many of the sorted bounds lie below the value: first among every ``2 ** (bits / 2)``-th, then between two of them."""
    if not bounds:
        return F.lit(0)
    step = 1 << bits // 2
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.array(*[F.lit(b) for b in bounds[step - 1::step]])
    below = lambda places, v: F.size(F.filter(places, lambda b: b < v))
    rank = lambda v: _let(below(coarse, v), lambda c: c * step + below(F.slice(every, c * step + 1, step - 1), v))
    return _let(value, lambda v: F.when(v.isNull(), 0).otherwise(rank(v)))


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """The place of a row on a space-filling curve through ``columns``.

    Each column gives its percentile rank, so every step holds about as many
    rows however its values are spread; the bits of the ranks are interleaved,
    highest first, so that rows near in all columns are near on the curve.
    Nulls rank lowest. Reads the columns once for the percentiles.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*[F.percentile_approx(_number(df, c), shares, 100 << bits).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    ranks = [_rank(_number(df, c), [float(b) for b in bounds[i] or []], bits) for i, c in enumerate(columns)]

    def interleaved(r: Column) -> Column:
        place = F.lit(0).cast("long")
        for bit in range(bits):
            for i in range(len(columns)):
                one = F.shiftright(F.get(r, i), bit).bitwiseAND(F.lit(1)).cast("long")
                place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i))
        return place

    return _let(F.array(*ranks), interleaved)


def curve_clustered(df: DataFrame, columns: Sequence[str], n: int | None = None, bits: int = CURVE_BITS) -> DataFrame:
    """Range layout along the curve through ``columns``: file footers prune for a filter on any of them.

    A plain range order on (a, b) prunes for a filter on ``a`` only. The row
    hash closes the key, so that one crowded place can fill several partitions.
    """
    place, spread = "__place", "__spread"
    ranges = [place, spread] if n is None else [n, place, spread]
    laid = df.withColumns({place: curve_place(df, columns, bits), spread: F.xxhash64(*df.columns)})
    return laid.repartitionByRange(*ranges).sortWithinPartitions(place, *columns).drop(place, spread)


def partition_report(df: DataFrame, layout: str) -> DataFrame:
    """One row: non-empty partitions, rows, smallest, largest, largest over mean."""
    per_partition = df.groupBy(F.spark_partition_id().alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    return per_partition.agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("__n").alias("total_rows"),
        F.min("__n").alias("min_rows"), F.max("__n").alias("max_rows"),
        F.round(F.max("__n") / F.avg("__n"), 4).alias("skew"),
    ).select(F.lit(layout).alias("layout"), "*")
