"""Key-frequency reports, salted joins and salted aggregation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.operators.ordered import null_safe
from tideline.session import written
from tideline.sinks.layout import replace_partitions

_SALT = "__salt"
SALTS = "salts"
SALTS_PER_PARTITION = 4
#: Keys that a one-pass profile counts exactly; beyond it the counts of the most frequent ones are estimates.
TRACKED_KEYS = 10_000


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), *keys)


def _share_and_shape(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Top-``n`` rows, all rows, key count and largest key, in one row.

    Both sides of the union read the same key counts, whose shuffle Spark reuses.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    none = F.lit(0).cast("long")
    top = counts.orderBy(F.desc("row_count")).limit(n).select(
        F.col("row_count").alias("top_rows"), none.alias("all_rows")
    )
    every = counts.select(none.alias("top_rows"), F.col("row_count").alias("all_rows"))
    return (
        top.unionByName(every)
        .agg(
            F.sum("top_rows").alias("top_rows"), F.sum("all_rows").alias("all_rows"),
            F.count_if(F.col("all_rows") > 0).alias("key_count"), F.max("all_rows").alias("largest_key_rows"),
        )
        .withColumn("top_share", F.round(F.col("top_rows") / F.nullif(F.col("all_rows"), F.lit(0)), 6))
    )


def top_key_share(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """One row: rows of the ``n`` most frequent keys, all rows, and their ratio."""
    return _share_and_shape(df, keys, n).select("top_rows", "all_rows", "top_share")


def skew_metrics(df: DataFrame, keys: Sequence[str], n: int, run_id: str) -> DataFrame:
    """One monitoring row per run, to be appended to a metric table."""
    return _share_and_shape(df, keys, n).select(
        F.lit(run_id).alias("run_id"), "key_count", "largest_key_rows", "top_rows", "all_rows", "top_share"
    )


def metered(df: DataFrame, keys: Sequence[str], n: int) -> tuple[DataFrame, Observation]:
    """``df`` that reports its skew while an action runs over it, and the report: no pass of its own.

    Counts of the ``n`` most frequent keys are exact while there are fewer keys than ``TRACKED_KEYS`` (three
    quarters of it); above that they are the estimates of a sketch of that size, close for the keys that matter.
    """
    key = ", ".join(f"`{k}`" for k in keys)
    report = Observation()
    return df.observe(
        report, F.count(F.lit(1)).alias("all_rows"), F.expr(f"approx_top_k(xxhash64({key}), {n}, {TRACKED_KEYS})").alias("top"),
    ), report


def append_metrics(spark: SparkSession, report: Observation, path: str, run_id: str) -> None:
    """The report as the row of ``run_id`` in the metric table at ``path``; a repeated run replaces its row."""
    found = report.get
    counts = [r["count"] for r in found["top"] or []]
    total = found["all_rows"]
    row = (run_id, total, max(counts, default=0), sum(counts), round(sum(counts) / total, 6) if total else None)
    kinds = "run_id string, all_rows long, largest_key_rows long, top_rows long, top_share double"
    replace_partitions(spark.createDataFrame([row], kinds), path, ["run_id"])


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metric table: a row per run."""
    kinds = "all_rows long, largest_key_rows long, top_rows long, top_share double, run_id string"
    return spark.read.schema(kinds).parquet(path)


def salt_of(identity: Sequence[str], salts: int) -> Column:
    """Salt from the row's own content: the same on a task retry, unlike ``rand``."""
    return F.pmod(F.xxhash64(*identity), F.lit(salts)).cast("int")


def _kept_side(how: str) -> None:
    if how not in ("inner", "left"):
        raise ValueError("a salted join keeps the fact side: use inner or left")


def fair_share(df: DataFrame, rows: int) -> int:
    """Rows that one salt of a key may have: a quarter of an even partition, so that where salts meet no task doubles."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(rows / (SALTS_PER_PARTITION * partitions)))


def salt_counts(df: DataFrame, keys: Sequence[str], target_rows: int | None = None) -> DataFrame:
    """Keys above ``target_rows`` and their ``salts``, ``ceil(rows / target_rows)`` each.

    Without a target it is a quarter of an even shuffle partition. There are
    fewer such keys than all rows divided by the target: with the default, four
    per partition at any size of the data. Written once, because both sides of a join ask for it.
    """
    target = target_rows or fair_share(df, df.count())
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > target)
    return written(counts.select(*keys, F.ceil(F.col("__n") / target).cast("int").alias(SALTS)), "salt-counts")


def _used_copies(dimension: DataFrame, spread: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dimension`` once for every salt that occurs in ``spread`` with its key.

    All salts for every key would be the dimension times the salts, which the planner takes for as small as the dimension.
    """
    return dimension.join(spread.select(*keys, _SALT).distinct(), list(keys)).select(*dimension.columns, _SALT)


def salted_join(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], identity: Sequence[str], salts: int | None = None, how: str = "inner"
) -> DataFrame:
    """Join in which every key is spread over ``salts`` partitions.

    Each fact row has one salt and the dimension has a copy for every salt that
    its key's fact rows have, so the result is that of the plain join (``inner``
    or ``left``) and a dimension row has no more copies than fact rows or
    salts. Without ``salts`` there are as many as the largest key needs.
    ``heavy_key_join`` copies the heavy keys only.
    """
    _kept_side(how)
    if salts is None:
        salts = salt_counts(fact, keys).agg(F.max(SALTS)).first()[0] or 1
    spread = fact.withColumn(_SALT, salt_of(identity, salts))
    return spread.join(_used_copies(dimension, spread, keys), [*keys, _SALT], how).drop(_SALT)


def _with_salts(df: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the number of salts of its key, 1 for all that are not heavy."""
    marked = counts.select(*[F.col(k).alias(f"__heavy_{k}") for k in keys], F.col(SALTS).alias("__own_salts"))
    joined = df.join(F.broadcast(marked), null_safe([(k, f"__heavy_{k}") for k in keys]), "left")
    return joined.select(*df.columns, F.coalesce("__own_salts", F.lit(1)).alias("__own_salts"))


def salted_sides(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], identity: Sequence[str], counts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with the column ``__salt``: one salt per fact row, a copy per salt of the dimension's key."""
    own = F.col("__own_salts")
    spread = _with_salts(fact, counts, keys).withColumn(_SALT, F.pmod(F.xxhash64(*identity), own).cast("int"))
    copies = _with_salts(dimension, counts, keys).withColumn(_SALT, F.explode(F.sequence(F.lit(0), own - 1)))
    return spread.drop("__own_salts"), copies.drop("__own_salts")


def heavy_key_join(
    fact: DataFrame, dimension: DataFrame, keys: Sequence[str], identity: Sequence[str], target_rows: int | None = None,
    how: str = "inner", counts: DataFrame | None = None,
) -> DataFrame:
    """Salt the heavy keys by their weight; all others keep salt 0 and one dimension copy.

    A key gets as many salts as its rows fill shares of ``target_rows``, so a key
    with a third of all rows spreads over more tasks the more there are. The
    table of counts (see ``salt_counts``; pass ``counts`` where it is known) is broadcast.
    """
    _kept_side(how)
    counts = salt_counts(fact, keys, target_rows) if counts is None else counts
    spread, copies = salted_sides(fact, dimension, keys, identity, counts)
    return spread.join(copies, [*keys, _SALT], how).drop(_SALT)


def salted_totals(
    df: DataFrame, keys: Sequence[str], identity: Sequence[str], amount: str, salts: int
) -> DataFrame:
    """Count, sum, minimum and maximum per key in two steps, salted then whole."""
    parts = (
        df.withColumn(_SALT, salt_of(identity, salts))
        .groupBy(*keys, _SALT)
        .agg(
            F.count(F.lit(1)).alias("__n"), F.sum(amount).alias("__sum"),
            F.min(amount).alias("__min"), F.max(amount).alias("__max"),
        )
    )
    return parts.groupBy(*keys).agg(
        F.sum("__n").alias("row_count"), F.sum("__sum").alias("total_amount"),
        F.min("__min").alias("min_amount"), F.max("__max").alias("max_amount"),
    )
