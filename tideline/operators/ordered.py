"""Previous and next row of a key, for keys of any size.

A plain ``lag``/``lead`` sends all rows of a key to one task. Here the keys are
counted first. If one holds more than a set share of the rows, it is cut into
slices along its order column; each slice is a window group of its own, and the
rows at the slice borders get their neighbour from a table with one row per
slice. Without such a key the plan is the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import position
from tideline.session import written

SLICE = "__slice"
SLICES = "__slices"


@dataclass(frozen=True)
class SplitPolicy:
    """When a key is cut.

    A key is heavy above ``max_share`` of all rows and above ``min_rows``. So
    there are fewer than ``1 / max_share`` heavy keys with at most
    ``2 / max_share`` slices together, whatever the size of the data: this
    bounds the two tables that are broadcast.
    """

    max_share: float = 1e-4
    min_rows: int = 1_000_000


def null_safe(pairs: Sequence[tuple[str, str]]) -> Column:
    """Equality of column pairs in which null equals null; the names must differ."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs])


@dataclass(frozen=True)
class Groups:
    """Rows with the keys that window groups are formed by; heavy keys come in slices."""

    rows: DataFrame
    keys: tuple[str, ...]
    sliced: bool

    @property
    def by(self) -> list[str]:
        return [*self.keys, SLICE] if self.sliced else list(self.keys)

    def over(self, rows: DataFrame) -> Groups:
        return Groups(rows, self.keys, self.sliced)

    def finished(self) -> DataFrame:
        return self.rows.drop(SLICE, SLICES)


def has_heavy_key(df: DataFrame, keys: Sequence[str], policy: SplitPolicy = SplitPolicy()) -> bool:
    """Whether a key of ``df`` would be cut: one job over the keys, for several windows over the same rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    size = counts.agg(F.sum("__n").alias("total"), F.max("__n").alias("largest")).first()
    return (size["largest"] or 0) > max(policy.min_rows, (size["total"] or 0) * policy.max_share)


def window_groups(
    df: DataFrame, keys: Sequence[str], along: str, policy: SplitPolicy | None = SplitPolicy(),
    profile_of: DataFrame | None = None,
) -> Groups:
    """Count the keys of ``df`` and cut the heavy ones along ``along``.

    Runs one job that reads keys and order column and returns a single row.
    Slices hold about equally many rows of ``profile_of`` (bounds are percentiles of
    the key's own values), so a burst is spread as well. The slices are written
    once, so retries and plan branches agree on them. ``profile_of`` may be
    a cheaper frame with about as many rows per key, or more.
    """
    whole = Groups(df, tuple(keys), sliced=False)
    if policy is None:
        return whole
    source = df if profile_of is None else profile_of
    placed = source.select(*keys, position(source, along).alias("__at"))
    profile = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    size = profile.agg(F.sum("__n").alias("total"), F.max("__n").alias("largest")).first()
    limit = max(policy.min_rows, (size["total"] or 0) * policy.max_share)
    if (size["largest"] or 0) <= limit:
        return whole

    most = math.ceil(size["largest"] / limit)
    heavy = profile.filter(F.col("__n") > limit).select(
        *[F.col(k).alias(f"__heavy_{k}") for k in keys], F.ceil(F.col("__n") / limit).cast("int").alias("__cuts"),
    )
    same = null_safe([(k, f"__heavy_{k}") for k in keys])
    shares = [i / most for i in range(1, most + 1)]
    bounds = placed.join(F.broadcast(heavy), same).groupBy(*[f"__heavy_{k}" for k in keys], "__cuts").agg(
        F.percentile_approx("__at", shares, 10 * most).alias("__all")
    )
    # A key's own number of bounds out of the list for the largest key; every `step`-th is looked at first.
    own = F.transform(F.sequence(F.lit(1), F.col("__cuts") - 1), lambda i: F.get("__all", (i * most / F.col("__cuts")).cast("int") - 1))
    step = F.ceil(F.sqrt(F.col("__cuts"))).cast("int")
    bounds = bounds.withColumn("__bounds", own).withColumn("__step", step).drop("__all")
    joined = df.join(F.broadcast(bounds), same, "left").withColumn("__at", position(df, along))
    passed = lambda b: b < F.col("__at")
    coarse = F.size(F.filter(F.filter("__bounds", lambda b, i: (i + 1) % F.col("__step") == 0), passed))
    joined = joined.withColumn("__coarse", coarse)
    fine = F.size(F.filter(F.slice("__bounds", F.col("__coarse") * F.col("__step") + 1, F.col("__step")), passed))
    cuts = F.coalesce(F.col("__cuts"), F.lit(1))
    cut = F.when(F.col("__cuts").isNull(), 0).otherwise(F.greatest(F.lit(0), F.col("__coarse") * F.col("__step") + fine)).cast("int")
    rows = joined.select(*df.columns, cuts.alias(SLICES), cut.alias(SLICE))
    # The slices are read more than once from here on: cut the lineage.
    return Groups(written(rows, "slices"), tuple(keys), sliced=True)


def _neighbour(groups: Groups, order: Sequence[str], values: Mapping[str, str], forward: bool) -> Groups:
    packed = F.struct(*[F.col(source).alias(name) for name, source in values.items()])
    shift = F.lead if forward else F.lag
    rows = groups.rows
    local = rows.withColumn("__local", shift(packed, 1).over(Window.partitionBy(*groups.by).orderBy(*order)))
    if not groups.sliced:
        return groups.over(local.select(*rows.columns, *[F.col("__local")[n].alias(n) for n in values]))

    border = F.min_by if forward else F.max_by
    per_slice = (
        rows.filter(F.col(SLICES) > 1).groupBy(*groups.by).agg(border(packed, F.struct(*order)).alias("__border"))
    )
    across = Window.partitionBy(*groups.keys).orderBy(SLICE)
    borders = per_slice.select(
        *[F.col(k).alias(f"__border_{k}") for k in groups.by], shift("__border", 1).over(across).alias("__across")
    )
    both = local.join(F.broadcast(borders), null_safe([(k, f"__border_{k}") for k in groups.by]), "left")
    found = F.coalesce(F.col("__local"), F.col("__across"))
    return groups.over(both.select(*rows.columns, *[found[n].alias(n) for n in values]))


def with_previous(groups: Groups, order: Sequence[str], values: Mapping[str, str]) -> Groups:
    """Add ``{new name: column}`` of the previous row of the key; null on its first row."""
    return _neighbour(groups, order, values, forward=False)


def with_next(groups: Groups, order: Sequence[str], values: Mapping[str, str]) -> Groups:
    """Add ``{new name: column}`` of the next row of the key; null on its last row."""
    return _neighbour(groups, order, values, forward=True)
