"""The latest-state table of a change feed, with a horizon below which deletes are forgotten.

A deleted key stays in the state, marked, so that an older event of it that
comes late brings nothing back. Such marks would pile up for ever. The horizon
bounds them: it lies a fixed time behind the newest event that any run has
seen. An event from before the horizon is refused and counted, so a mark from
before it has nothing left to keep out and goes.

The state lies in buckets of the key. A run writes the buckets its events fall
into, and those whose oldest mark has passed the horizon. The horizon, the
count of refused events and the oldest marks are published together with the state.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import cdc
from tideline.operators.scd import Dimension
from tideline.session import written
from tideline.sinks import zones

BUCKETS = 64
KEEP = "90 days"
STATE = "state"
_HORIZON, _REFUSED, _MARKS, _NUMBER = "horizon", "refused", "oldest marks", "buckets"


@dataclass(frozen=True)
class Retention:
    """Events from before ``horizon`` are refused; ``refused`` counts those of all runs."""

    horizon: str | None
    refused: int


def retention(spark: SparkSession, root: str) -> Retention:
    notes = zones.current(spark, root).notes
    return Retention(notes.get(_HORIZON) or None, int(notes.get(_REFUSED, 0)))


def state(spark: SparkSession, root: str) -> DataFrame:
    """The stored state, marks included; ``cdc.live`` gives what readers see."""
    layout = zones.current(spark, root)
    return zones.read(spark, root, STATE, layout)


def _later(a: str | None, b: str | None) -> str | None:
    return max((t for t in (a, b) if t), default=None)


def advance(
    spark: SparkSession, batch: DataFrame, root: str, dim: Dimension, keep: str = KEEP, buckets: int = BUCKETS,
) -> Retention:
    """Apply a batch of change events; replays and any order of batches give the same state within the horizon.

    Events without a time cannot be placed and are refused as well.
    """
    layout, run = zones.current(spark, root), zones.next_run(spark, root)
    if not layout.notes:
        empty = cdc.empty_state(batch, dim.keys, dim.tracked, dim.time, dim.tiebreak)
        layout.note_schema(STATE, empty.schema)
        layout.notes |= {_NUMBER: str(buckets), _MARKS: "{}", _REFUSED: "0", _HORIZON: ""}
    kinds, time = layout.schema(STATE), dim.time
    part = F.pmod(F.xxhash64(*dim.keys), F.lit(int(layout.notes[_NUMBER]))).cast("int")
    text = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    # The bucket is a hash of the key, so later batches take the column types of the first one.
    given = cdc.valid_operations(batch).select(
        *[F.col(c).cast(kinds[c].dataType).alias(c) for c in (*dim.keys, *dim.tracked, *dim.tiebreak)],
        F.col(time).cast(kinds["updated_at"].dataType).alias(time), "operation",
    )
    old = layout.notes[_HORIZON] or None
    in_time = F.col(time).isNotNull() if old is None else F.coalesce(F.col(time) >= F.lit(old).cast(kinds["updated_at"].dataType), F.lit(False))
    events = written(given.withColumn("__in_time", in_time), "events")
    seen = events.agg(
        F.count_if(~F.col("__in_time")).alias("refused"), text(F.max(time) - F.expr(f"INTERVAL {keep}")).alias("horizon")
    ).first()
    events = events.filter("__in_time").drop("__in_time")
    horizon = _later(old, seen["horizon"])

    marks: dict[str, str] = json.loads(layout.notes[_MARKS])
    touched = {r[0] for r in events.select(part).distinct().collect()}  # at most as many as buckets
    parts = touched | {int(p) for p, oldest in marks.items() if horizon and oldest < horizon}
    following = cdc.apply_feed(zones.read(spark, root, STATE, layout, parts), events, dim.keys, dim.tracked, time, dim.tiebreak)
    if horizon:
        spent = F.col(cdc.DELETED) & (F.col("updated_at") < F.lit(horizon).cast(kinds["updated_at"].dataType))
        following = following.filter(~spent)
    if parts:
        full = zones.write(spark, root, run, zones.placed(following, STATE, part).drop(zones.GONE)).get(STATE, set())
        for p in parts:
            layout.parts(STATE).pop(p, None)
            marks.pop(str(p), None)
        for p in full:
            layout.parts(STATE)[p] = [run]
        found = zones.read(spark, root, STATE, layout, full).filter(F.col(cdc.DELETED))
        for row in found.groupBy(part.alias("p")).agg(text(F.min("updated_at")).alias("oldest")).collect():
            marks[str(row["p"])] = row["oldest"]
    refused = int(layout.notes[_REFUSED]) + seen["refused"]
    layout.notes |= {_HORIZON: horizon or "", _REFUSED: str(refused), _MARKS: json.dumps(marks)}
    zones.publish(spark, root, run, layout)
    return Retention(horizon, refused)


def live(spark: SparkSession, root: str, dim: Dimension) -> DataFrame:
    """What readers see: the newest row of every key that is not deleted."""
    return cdc.live(state(spark, root), dim.keys, dim.tracked)
