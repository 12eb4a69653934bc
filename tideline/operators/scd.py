"""Type 2 dimensions: rows valid over ``[effective_from, effective_to)``.

An open end is null. The row hash is a stored column of the dimension.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.hashing import row_hash
from tideline.functions.scalars import moment
from tideline.operators.dedup import latest_per_key
from tideline.operators.joins import BROADCAST_BYTES, changed_rows
from tideline.operators.merge import matched_pairs
from tideline.operators.ordered import SplitPolicy, window_groups, with_next, with_previous

FROM, TO, CURRENT, HASH = "effective_from", "effective_to", "is_current", "record_hash"
_GONE = "gone"


@dataclass(frozen=True)
class Dimension:
    """Columns of a versioned dimension and of the updates that feed it."""

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    time: str = "updated_at"
    tiebreak: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.tracked, FROM, TO, CURRENT, HASH]

    @property
    def newest_first(self) -> list[str]:
        return [self.time, *self.tiebreak]


def _open_version(df: DataFrame, dim: Dimension) -> DataFrame:
    started = F.col(dim.time)
    return df.select(
        *dim.keys, *dim.tracked, started.alias(FROM),
        F.lit(None).cast(df.schema[dim.time].dataType).alias(TO), F.lit(True).alias(CURRENT), HASH,
    )


def latest_updates(updates: DataFrame, dim: Dimension) -> DataFrame:
    """The newest update of each key, with its hash."""
    newest = latest_per_key(updates, dim.keys, dim.newest_first)
    return newest.withColumn(HASH, row_hash(newest, dim.tracked))


def current_slice(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col(CURRENT))


def initial_load(updates: DataFrame, dim: Dimension) -> DataFrame:
    """First load: the newest update of each key becomes its open version."""
    return _open_version(latest_updates(updates, dim), dim)


def detect_changes(dimension: DataFrame, updates: DataFrame, dim: Dimension, include_new: bool = True) -> DataFrame:
    """Newest updates that are new or differ from the current slice.

    Only the current slice is compared: against all history a key with any
    older, different version would count as changed on every run.
    """
    return changed_rows(latest_updates(updates, dim), current_slice(dimension), dim.keys, HASH, include_new)


def apply_updates(
    dimension: DataFrame, updates: DataFrame, dim: Dimension, insert_new: bool = True,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Close changed versions and open their successors, in one plan from one snapshot.

    Closed versions pass through untouched; only the current slice is joined. An
    update older than the current start is left for the late path, and one at
    the very same time replaces the version instead of leaving an empty interval.
    """
    incoming = _open_version(latest_updates(updates, dim), dim)
    pairs = matched_pairs(current_slice(dimension), incoming, dim.keys, broadcast_limit)
    old, new = F.col(f"t.{FROM}"), F.col(f"s.{FROM}")
    changed = F.col("s").isNotNull() & (F.col(f"t.{HASH}") != F.col(f"s.{HASH}"))
    fresh = F.array(F.lit("open")) if insert_new else F.array().cast("array<string>")
    steps = (
        F.when(F.col("t").isNull(), fresh)
        .when(changed & (new > old), F.array(F.lit("close"), F.lit("open")))
        .when(changed & (new == old), F.array(F.lit("open")))
        .otherwise(F.array(F.lit("keep")))
    )
    rows = pairs.withColumn("__step", F.explode(steps))
    opens, closes = F.col("__step") == "open", F.col("__step") == "close"

    def pick(name: str) -> Column:
        value = F.when(opens, F.col(f"s.{name}"))
        if name == TO:
            value = value.when(closes, new)
        elif name == CURRENT:
            value = value.when(closes, F.lit(False))
        return value.otherwise(F.col(f"t.{name}")).alias(name)

    closed = dimension.filter(~F.col(CURRENT)).select(*dim.columns)
    return closed.unionByName(rows.select(*[pick(c) for c in dim.columns]))


def build_history(
    changes: DataFrame, dim: Dimension, deleted: Column | None = None, split: SplitPolicy | None = SplitPolicy(),
    profile_of: DataFrame | None = None,
) -> DataFrame:
    """All versions from a change log: each real change opens an interval.

    Several changes at one time count as the last of them, replays and repeats
    of the same values are no change, and a delete ends the interval without
    opening another. Keys of any size are handled, see ``operators.ordered``;
    ``profile_of`` may be a cheaper frame to count the changes per key in.
    """
    marked = changes.withColumn(_GONE, F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False))
    points = latest_per_key(marked, [*dim.keys, dim.time], list(dim.tiebreak) or [*dim.tracked])
    points = points.withColumn(HASH, row_hash(points, dim.tracked)).withColumn(
        "__state", F.when(F.col(_GONE), F.lit("")).otherwise(F.col(HASH))
    ).select(*dim.keys, *dim.tracked, dim.time, _GONE, HASH, "__state")

    groups = window_groups(points, dim.keys, dim.time, split, changes if profile_of is None else profile_of)
    before = with_previous(groups, [dim.time], {"__before": "__state"})
    real = before.rows.filter(F.col("__state") != F.coalesce("__before", F.lit(""))).drop("__before")
    ended = with_next(before.over(real), [dim.time], {"__until": dim.time})
    return ended.finished().filter(~F.col(_GONE)).select(
        *dim.keys, *dim.tracked, F.col(dim.time).alias(FROM), F.col("__until").alias(TO),
        F.col("__until").isNull().alias(CURRENT), HASH,
    )


def late_updates(dimension: DataFrame, updates: DataFrame, dim: Dimension) -> DataFrame:
    """Updates whose time lies before the start of their key's current version."""
    started = current_slice(dimension).select(*dim.keys, F.col(FROM).alias("__started"))
    joined = updates.join(started, list(dim.keys), "inner").filter(F.col(dim.time) < F.col("__started"))
    return joined.select(*updates.columns)


def rebuild_from_log(
    dimension: DataFrame, log: DataFrame, late: DataFrame, dim: Dimension, deleted: Column | None = None,
    split: SplitPolicy | None = SplitPolicy(),
) -> DataFrame:
    """Late correction, exact: rebuild the keys of ``late`` from the change log.

    The result equals ``build_history`` over the whole log. Repeats that the
    dimension dropped matter here: after a late change in between, a repeat is
    a real change back.
    """
    touched = late.select(*dim.keys).distinct()
    untouched = dimension.join(touched, list(dim.keys), "left_anti").select(*dim.columns)
    points = log.join(touched, list(dim.keys), "left_semi").unionByName(late)
    known = log.select(*dim.keys, dim.time).unionByName(late.select(*dim.keys, dim.time))
    return untouched.unionByName(build_history(points, dim, deleted, split, known))


def insert_late_versions(
    dimension: DataFrame, late: DataFrame, dim: Dimension, split: SplitPolicy | None = SplitPolicy(),
) -> DataFrame:
    """Late correction from the dimension alone: split the interval that holds the late time.

    The late values hold until the next stored version starts. Use
    ``rebuild_from_log`` where the change log is kept.
    """
    touched = late.select(*dim.keys).distinct()
    untouched = dimension.join(touched, list(dim.keys), "left_anti").select(*dim.columns)
    affected = dimension.join(touched, list(dim.keys), "left_semi")
    # A version gives its start and, if closed, its end as change points, in one
    # pass. At one time, a late row beats a stored start, and a start beats an end.
    start = F.struct(F.col(FROM).alias("at"), F.lit(False).alias("ends"), F.lit(1).alias("rank"))
    end = F.struct(F.col(TO).alias("at"), F.lit(True).alias("ends"), F.lit(0).alias("rank"))
    stored = affected.withColumn("__point", F.explode(F.when(F.col(TO).isNull(), F.array(start)).otherwise(F.array(start, end))))
    stored = stored.select(
        *dim.keys, *dim.tracked, F.col("__point.at").alias(dim.time), F.col("__point.ends").alias("__ends"),
        F.col("__point.rank").alias("__rank"),
    )
    inserted = latest_per_key(late, [*dim.keys, dim.time], list(dim.tiebreak) or [*dim.tracked]).select(
        *dim.keys, *dim.tracked, dim.time, F.lit(False).alias("__ends"),
        F.lit(2).alias("__rank"),
    )
    points = stored.unionByName(inserted)
    ranked = Dimension(dim.keys, dim.tracked, dim.time, ("__rank",))
    known = dimension.select(*dim.keys, F.col(FROM).alias(dim.time)).unionByName(late.select(*dim.keys, dim.time))
    return untouched.unionByName(build_history(points, ranked, F.col("__ends"), split, known))


def as_of(dimension: DataFrame, when: datetime | str) -> DataFrame:
    """Versions in force at ``when``."""
    at = moment(when, dimension.schema[FROM].dataType)
    return dimension.filter((F.col(FROM) <= at) & (F.col(TO).isNull() | (F.col(TO) > at)))


def multiple_active(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one current version; must be empty."""
    return (
        dimension.groupBy(*keys)
        .agg(F.sum(F.col(CURRENT).cast("int")).alias("active_count"))
        .filter(F.col("active_count") > 1)
    )


def overlapping(
    dimension: DataFrame, keys: Sequence[str], split: SplitPolicy | None = SplitPolicy()
) -> DataFrame:
    """Versions that end after the next one starts, or never end although one follows."""
    groups = with_next(window_groups(dimension, keys, FROM, split), [FROM, TO, HASH], {"next_start": FROM})
    late_end = F.col(TO).isNull() | (F.col(TO) > F.col("next_start"))
    return groups.finished().filter(F.col("next_start").isNotNull() & late_end)
