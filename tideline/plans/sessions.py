"""The published session table: dated output, and an index of the dates each session is published under.

``<root>/sessions/event_date=<d>/`` holds the sessions that start on a day. A
late or corrected event can move a session to another day, so a run must know
where the session stood. ``<root>/index`` says so: pairs of session and date by
bucket of the session, of which a run reads the buckets of its sessions only.
The index is published after the output; a run that failed in between is
repeated and finds the dates as they were before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.joins import rows_of
from tideline.plans.marts import affected_sessions, session_metrics
from tideline.session import written
from tideline.sinks import zones
from tideline.sinks.layout import replace_within

# Fixed value: rows per output file.
FILE_ROWS = 500_000
BUCKETS = 64
DATE, INDEX = "event_date", "index"
_PAIR = ("session_id", DATE)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The published sessions."""
    return spark.read.parquet(f"{root}/sessions")


def publish(events: DataFrame, products: DataFrame, root: str, boundary=None, buckets: int = BUCKETS) -> int:
    """Publish all sessions, or those that an event newer than ``boundary`` is or was in; returns the run's number.

    Only the dates that such a session had or now has are replaced; a date
    without sessions loses its folder. ``buckets`` counts for the first run.
    """
    spark, index = events.sparkSession, f"{root}/index"
    layout, run = zones.current(spark, index), zones.next_run(spark, index)
    first = not layout.notes
    if first and boundary is not None:
        raise FileNotFoundError(f"no sessions under {root}: publish all of them first")
    sessions = None if boundary is None else written(affected_sessions(events, boundary), "affected-sessions")
    metrics = written(session_metrics(events, products, sessions=sessions), "session-metrics")
    now = metrics.select(*_PAIR).distinct()
    if first:
        layout.notes["buckets"] = str(buckets)
        layout.note_schema(INDEX, now.schema)
    part = F.pmod(F.xxhash64("session_id"), F.lit(int(layout.notes["buckets"]))).cast("int")

    if sessions is None:
        before = zones.read(spark, index, INDEX, layout)
    else:
        parts = [r[0] for r in sessions.select(part).distinct().collect()]  # at most `buckets`
        before = rows_of(zones.read(spark, index, INDEX, layout, parts), sessions, ["session_id"])
    before = written(before, "published-dates")
    dates = before.select(DATE).unionByName(now.select(DATE)).distinct()
    content = metrics
    if sessions is not None:
        days = [r[0] for r in dates.collect()]  # one row per calendar day
        known = F.col(DATE).isin([d for d in days if d is not None])
        stored = read(spark, root).filter(known | F.col(DATE).isNull() if None in days else known)
        content = rows_of(stored, sessions, ["session_id"], "left_anti").select(*metrics.columns).unionByName(metrics)
    replace_within(spark, content, f"{root}/sessions", DATE, dates, FILE_ROWS)

    new, old = rows_of(now, before, _PAIR, "left_anti"), rows_of(before, now, _PAIR, "left_anti")
    moves = zones.placed(new, INDEX, part).unionByName(zones.placed(old, INDEX, part, True))
    zones.change(spark, index, layout, run, written(moves, "moved-sessions"), _PAIR)
    return zones.publish(spark, index, run, layout)
