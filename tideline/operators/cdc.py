"""Change feed to latest-state table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.hashing import row_hash
from tideline.functions.scalars import moment
from tideline.operators.dedup import latest_per_key
from tideline.operators.merge import merge

# The operations of a change feed.
INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
OPERATIONS = (INSERT, UPDATE, DELETE)
DELETED = "is_deleted"


def valid_operations(events: DataFrame, operation: str = "operation") -> DataFrame:
    return events.filter(F.col(operation).isin(*OPERATIONS))


def empty_state(
    events: DataFrame, keys: Sequence[str], tracked: Sequence[str], time: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The state before the first load, so first and later loads share one path."""
    return events.select(
        *keys, *tracked, *tiebreak, F.lit("").alias("hash_value"), F.col(time).alias("updated_at"), F.lit(False).alias(DELETED)
    ).filter(F.lit(False))


def live(state: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """What readers see: the state without deleted keys."""
    return state.filter(~F.col(DELETED)).select(*keys, *tracked, "hash_value", "updated_at")


def apply_feed(
    state: DataFrame, events: DataFrame, keys: Sequence[str], tracked: Sequence[str], time: str = "event_time",
    tiebreak: Sequence[str] = (), operation: str = "operation",
) -> DataFrame:
    """Latest state after ``events``; deleted keys stay in it, marked, with the time they went.

    The newest event of a key wins by time and tiebreak, whatever order or how
    often the batches arrive: an older one finds the newer row or the mark and changes nothing. Invalid operations go first: kept until after the dedup, an invalid last
    event would hide the valid one before it.
    """
    latest = latest_per_key(valid_operations(events, operation), keys, [time, *tiebreak])
    source = latest.withColumn("hash_value", row_hash(latest, [*keys, *tracked]))
    newer = F.struct(F.col(f"s.{time}").alias("at"), *[F.col(f"s.{c}") for c in tiebreak])
    stored = F.struct(F.col("t.updated_at").alias("at"), *[F.col(f"t.{c}") for c in tiebreak])
    values = {name: name for name in [*tracked, *tiebreak, "hash_value"]}
    values |= {"updated_at": time, DELETED: F.col(f"s.{operation}") == DELETE}
    return merge(state, source, keys, update=values, update_when=newer >= stored, insert=values | {k: k for k in keys}, unique=True)


def late_events(events: DataFrame, now: datetime | str, allowed: str = "1 day", time: str = "event_time") -> DataFrame:
    """Events older than ``allowed`` at ``now``; the caller passes ``now`` so that reruns agree."""
    boundary = moment(now, events.schema[time].dataType) - F.expr(f"INTERVAL {allowed}")
    return events.filter(F.col(time) < boundary)
