"""Audit totals of a published table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.sinks.layout import overwrite


def totals(published: DataFrame, keys: Sequence[str], **sums: str) -> DataFrame:
    """Per-key sums of a published table: ``new_name="column"``."""
    return published.groupBy(*keys).agg(*[F.sum(column).alias(name) for name, column in sums.items()])


def write_totals(published: DataFrame, path: str, keys: Sequence[str], **sums: str) -> None:
    overwrite(totals(published, keys, **sums), path)


def compare(published: DataFrame, recomputed: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Both values of ``measure`` per key and their difference; a missing key counts as 0.

    Both inputs are totals with one row per key.
    """
    left = published.select(*keys, F.col(measure).alias("published"))
    right = recomputed.select(*keys, F.col(measure).alias("recomputed"))
    both = left.join(right, list(keys), "full_outer").fillna(0, ["published", "recomputed"])
    return both.withColumn("difference", F.col("published") - F.col("recomputed"))
