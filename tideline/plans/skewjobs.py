"""Fact and dimension joins whose key may be badly skewed."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tideline.operators import skew
from tideline.operators.joins import BROADCAST_BYTES, dimension_join, is_small, planned_bytes
from tideline.operators.skew import heavy_key_join
from tideline.sinks.layout import overwrite, replace_partitions

# Rows per output file, bytes per shuffle partition.
FILE_ROWS = 500_000
PARTITION_BYTES = 256 * 1024 * 1024
TOP_KEYS = 10
BROADCAST, PLAIN, SALTED = "broadcast", "plain", "salted"


@dataclass(frozen=True)
class JoinPlan:
    """How to join: the way, the number of shuffle partitions, and the salts of the heavy keys."""

    way: str
    partitions: int
    counts: DataFrame | None = None


def choose(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], broadcast_limit: int = BROADCAST_BYTES,
    partition_bytes: int = PARTITION_BYTES,
) -> JoinPlan:
    """The plan of a join, from the planned sizes and one count of the fact's keys.

    A dimension within ``broadcast_limit`` is broadcast: the fact is not
    shuffled, so its keys need no profile. Otherwise both sides are shuffled
    into partitions of ``partition_bytes``, and a key with more than twice the
    rows of an even partition makes the heavy keys salted, each by its weight.
    The planned size starts from the files, which are compressed; it errs towards fewer partitions.
    """
    partitions = max(1, math.ceil((planned_bytes(fact) + planned_bytes(dimension)) / partition_bytes))
    if is_small(dimension, broadcast_limit):
        return JoinPlan(BROADCAST, partitions)
    even = fact.count() / partitions
    counts = skew.salt_counts(fact, keys, max(1, math.ceil(even / skew.SALTS_PER_PARTITION)))
    heaviest = counts.agg({skew.SALTS: "max"}).first()[0] or 0
    return JoinPlan(SALTED, partitions, counts) if heaviest > 2 * skew.SALTS_PER_PARTITION and partitions > 1 else JoinPlan(PLAIN, partitions)


def carry_out(plan: JoinPlan, fact: DataFrame, dimension: DataFrame, keys: Sequence[str], identity: Sequence[str]) -> DataFrame:
    """The join by ``plan``. Both sides are laid out by the join's own key, so the join adds no shuffle to that."""
    if plan.way == BROADCAST:
        return dimension_join(fact, dimension, keys, limit=planned_bytes(dimension))
    on, left, right = list(keys), fact, dimension
    if plan.way == SALTED:
        left, right = skew.salted_sides(fact, dimension, keys, identity, plan.counts)
        on = [*keys, skew._SALT]
    joined = left.repartition(plan.partitions, *on).join(right.repartition(plan.partitions, *on).hint("merge"), on)
    return joined.drop(skew._SALT)


def _published(joined: DataFrame, keys: Sequence[str], write, metrics: str | None, run_id: str | None) -> None:
    """Write the output; with a metric table, its skew is noted by the pass that writes it."""
    if metrics is None:
        write(joined)
        return
    watched, report = skew.metered(joined, keys, TOP_KEYS)
    write(watched)
    skew.append_metrics(joined.sparkSession, report, metrics, run_id)


def skew_safe(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], identity: Sequence[str], day: str, path: str,
    metrics: str | None = None, run_id: str | None = None,
) -> None:
    """Join with only the heavy keys salted, by their weight, written by day."""
    _published(
        heavy_key_join(fact, dimension, keys, identity), keys, lambda df: replace_partitions(df, path, [day]), metrics, run_id
    )


def tuned(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], identity: Sequence[str], path: str,
    broadcast_limit: int = BROADCAST_BYTES, partition_bytes: int = PARTITION_BYTES, metrics: str | None = None, run_id: str | None = None,
) -> JoinPlan:
    """Profile, choose the plan, join, and cap the rows per output file; returns the plan."""
    plan = choose(fact, dimension, keys, broadcast_limit, partition_bytes)
    joined = carry_out(plan, fact, dimension, keys, identity)
    _published(joined, keys, lambda df: overwrite(df, path, FILE_ROWS), metrics, run_id)
    return plan


def flat(fact: DataFrame, dimension: DataFrame, keys: Sequence[str], path: str) -> None:
    """Broadcast the dimension while it is small enough, write one flat table."""
    overwrite(dimension_join(fact, dimension, keys), path)
