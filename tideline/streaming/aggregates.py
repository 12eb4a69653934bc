"""Windowed stream aggregates with bounded state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import money, money_out


def distinct_events(
    stream: DataFrame, keys: Sequence[str], time: str, delay: str, spread_copies: bool = False
) -> DataFrame:
    """First arrival of each event; an id is forgotten once ``delay`` has passed.

    Plain ``dropDuplicates`` on an id without the event time never forgets, and
    its state grows for as long as the stream runs.

    With ``spread_copies`` the copies of one id within a batch are first reduced
    where they were read, and only then by id: for feeds in which a single id
    may make up much of a batch. It costs a second state entry per id.
    """
    events = stream.withWatermark(time, delay)
    if spread_copies:
        events = (
            events.withColumn("__task", F.spark_partition_id())
            .dropDuplicatesWithinWatermark([*keys, "__task"])
            .drop("__task")
        )
    return events.dropDuplicatesWithinWatermark(list(keys))


def amount_metrics(
    events: DataFrame, keys: Sequence[str], time: str, amount: str, length: str = "1 hour"
) -> DataFrame:
    """Count, sum and average per tumbling window and key.

    The sum is over exact cents, so a replay gives the same figure.
    """
    grouped = events.groupBy(F.window(time, length), *keys).agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum(money(amount)).alias("__total")
    )
    total = money_out("__total")
    return grouped.select(
        "window", *keys, "txn_count", total.alias("total_amount"), (total / F.col("txn_count")).alias("avg_amount")
    )


def sliding_counts(
    events: DataFrame, keys: Sequence[str], time: str, length: str, slide: str, delay: str
) -> DataFrame:
    """Events per sliding window and key. Each event is counted in length / slide windows."""
    return (
        events.withWatermark(time, delay)
        .groupBy(*keys, F.window(time, length, slide))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def session_counts(events: DataFrame, keys: Sequence[str], time: str, gap: str, delay: str) -> DataFrame:
    """Events per session: a run of events of a key with pauses shorter than ``gap``."""
    return (
        events.withWatermark(time, delay)
        .groupBy(*keys, F.session_window(time, gap))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def daily_counts(events: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One small state row per key and day, to be rolled up in batch.

    Replaces a long sliding window, which keeps length / slide rows per key, for
    measures that add up.
    """
    return (
        events.withWatermark(time, delay)
        .groupBy(*keys, F.window(time, "1 day"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def flat_window(df: DataFrame, window: str = "window") -> DataFrame:
    """``window`` as two zone-less columns, first in the row."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").cast("timestamp_ntz").alias("window_start"),
        F.col(f"{window}.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )
