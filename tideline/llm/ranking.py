"""Ranks over a whole table without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import written

_WITHIN = (1 << 33) - 1  # the low bits of monotonically_increasing_id count within a partition


def numbered(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with the row's place (from 0) in ``order``: a sort by ranges, then one offset per range.

    The sorted rows are written once, so that both the counts and the places
    come from the same rows whatever is recomputed. The window runs over one row per range.
    """
    sorted_rows = df.sort(*order)
    placed = written(sorted_rows.select(
        "*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)).alias("__at")
    ), "sorted")
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return placed.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__offset") + F.col("__at")).drop("__part", "__at", "__offset")
