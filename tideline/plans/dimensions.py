"""Dimension pipelines: what a batch changes, checked, then published once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import cdc, scd
from tideline.operators.checks import require_empty, require_sound_dimension, unsound
from tideline.operators.ordered import SplitPolicy, has_heavy_key, null_safe
from tideline.operators.scd import Dimension
from tideline.session import written
from tideline.sinks import snapshots, zones
from tideline.sources.incremental import newer_than

CUSTOMERS = Dimension(
    ("customer_id",), ("name", "email", "address", "risk_level"), "updated_at", ("ingestion_time", "seq")
)
PRODUCTS = Dimension(("product_id",), ("product_name", "category", "price", "status"), "updated_at")
CITIES = Dimension(("customer_id",), ("city",), "event_time", ("seq",))
_SIDE, _UNSOUND = "__side", "__unsound"
ARRIVED = "arrived_in_run"


def next_state(dimension: DataFrame, updates: DataFrame, dim: Dimension, insert_new: bool = True) -> DataFrame:
    """The dimension after ``updates``: late ones put in their place, then the newest applied.

    Late rows lie before the current version, so they are placed in the stored
    table first. Without any, the history of the dimension is not joined at all.
    """
    late = written(scd.late_updates(dimension, updates, dim), "late-updates")
    if not late.isEmpty():
        dimension = scd.insert_late_versions(dimension, late, dim)
    return scd.apply_updates(dimension, updates, dim, insert_new)


BUCKETS = 64
OPEN, CLOSED, LOG = "open", "closed", "log"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _month(time: str) -> Column:
    return (F.year(time) * 100 + F.month(time)).cast("int")


def exists(spark: SparkSession, root: str) -> bool:
    return zones.exists(spark, root) or snapshots.exists(spark, root)


def read(spark: SparkSession, root: str) -> DataFrame:
    """All versions of the dimension at ``root``."""
    if not zones.exists(spark, root):
        return snapshots.read(spark, root)
    layout = zones.current(spark, root)
    return zones.read(spark, root, OPEN, layout).unionByName(zones.read(spark, root, CLOSED, layout))


def read_as_of(spark: SparkSession, root: str, when: datetime | str) -> DataFrame:
    """Versions in force at ``when``; months of versions that had ended by then are not read."""
    if not zones.exists(spark, root):
        return scd.as_of(read(spark, root), when)
    layout = zones.current(spark, root)
    at = datetime.fromisoformat(str(when))
    later = [m for m in layout.parts(CLOSED) if m >= at.year * 100 + at.month]
    versions = zones.read(spark, root, OPEN, layout).unionByName(zones.read(spark, root, CLOSED, layout, later))
    return scd.as_of(versions, when)


def maintain(
    spark: SparkSession, updates: DataFrame, root: str, dim: Dimension, boundary=None, insert_new: bool = True,
    latest_only: bool = False, deleted: Column | None = None, extra: Sequence[str] = (), buckets: int = BUCKETS,
) -> int:
    """Load or advance the dimension at ``root`` with updates newer than ``boundary``; returns the run's number.

    Every update of a key becomes part of its history, so the result is the
    same however the updates are cut into batches and in whatever order these
    arrive. ``read`` gives the dimension. It has three zones, published together:

    - open versions and the log of all updates, each by bucket of the key,
    - closed versions by the month they end in.

    A run reads the log of the keys in its batch, from their buckets only, and
    builds their histories without and with the batch. What differs is all that
    is written: months that only gain versions get a folder more and keep their
    files, and only a month that loses a version (a late update split it) is
    written again. The check looks at the keys of the batch; all others are as they were when checked before.

    ``deleted`` marks updates that end a version and open none; ``extra`` names
    the columns it needs. ``buckets`` counts for the first run and is then kept.

    ``latest_only=True`` keeps no updates and looks at the newest one of each
    key in a batch (and at late ones): cheaper, but batching then shows in the history.
    ``insert_new=False`` is the changed-only variant: unknown keys are left out.
    """
    batch = newer_than(updates, boundary)
    if latest_only:
        known = snapshots.exists(spark, root)
        content = next_state(snapshots.read(spark, root), batch, dim, insert_new) if known else scd.initial_load(batch, dim)
        return snapshots.publish(content, root, check=lambda d: require_sound_dimension(d, dim.keys))
    layout, run = zones.current(spark, root), zones.next_run(spark, root)
    first = not layout.notes
    columns = list(dict.fromkeys([*dim.keys, *dim.tracked, dim.time, *dim.tiebreak, *extra]))
    batch = batch.select(*columns)
    if first:
        layout.notes["buckets"] = str(buckets)
        layout.note_schema(LOG, T.StructType([*batch.schema.fields, T.StructField(ARRIVED, T.IntegerType())]))
    part, kinds = _bucket(dim.keys, int(layout.notes["buckets"])), layout.schema(LOG)
    # The bucket is a hash of the key, so later batches take the column types of the first one.
    batch = batch.select(*[F.col(c).cast(kinds[c].dataType).alias(c) for c in columns])
    if not first and not insert_new:
        batch = written(batch, "batch")
        parts = [r[0] for r in batch.select(part).distinct().collect()]  # at most `buckets`
        batch = batch.join(zones.read(spark, root, LOG, layout, parts).select(*dim.keys).distinct(), list(dim.keys), "left_semi")

    crowded = layout.crowded(LOG)
    arrived = zones.placed(batch.withColumn(ARRIVED, F.lit(run)), LOG, part).drop(zones.GONE)
    if crowded:
        stored = zones.read(spark, root, LOG, layout, crowded, with_part=True)
        arrived = arrived.unionByName(stored.withColumn(zones.ZONE, F.lit(LOG)))
    parts = zones.write(spark, root, run, arrived).get(LOG, set())
    for p in parts:
        layout.parts(LOG)[p] = [run] if p in crowded else [*layout.parts(LOG).get(p, []), run]
    log = zones.read(spark, root, LOG, layout, parts)
    # Every update of the batch's keys, once for the history without the batch and once for the one with it.
    fresh, heavy = F.col(ARRIVED) == run, has_heavy_key(log, dim.keys)
    if heavy:
        touched = log.filter(fresh).select(*[F.col(k).alias(f"__touched_{k}") for k in dim.keys]).distinct()
        points = log.join(touched, null_safe([(k, f"__touched_{k}") for k in dim.keys]), "left_semi")
    else:  # a key lies in one place: this shuffle serves the windows, the check and the sums below
        of_key = Window.partitionBy(*dim.keys)
        points = log.repartition(*dim.keys).withColumn("__touched", F.max(fresh).over(of_key)).filter("__touched").drop("__touched")
    points = points.withColumn(_SIDE, F.explode(F.when(fresh, F.array(F.lit(1))).otherwise(F.array(F.lit(-1), F.lit(1)))))
    both = Dimension((_SIDE, *dim.keys), dim.tracked, dim.time, dim.tiebreak)
    histories = scd.build_history(points, both, deleted, SplitPolicy() if heavy else None, log.withColumn(_SIDE, F.lit(1)))
    if heavy:
        histories = written(histories, "touched-histories")
        require_sound_dimension(histories.filter(F.col(_SIDE) == 1), dim.keys)
        histories = histories.withColumn(_UNSOUND, F.lit(False))
    else:
        histories = histories.withColumn(_UNSOUND, (F.col(_SIDE) == 1) & unsound([_SIDE, *dim.keys]))
    # A version that is there without and with the batch counts 0 and is left alone.
    sums = histories.groupBy(*dim.columns).agg(F.sum(_SIDE).alias(_SIDE), F.max(_UNSOUND).alias(_UNSOUND))
    sums = sums.filter((F.col(_SIDE) != 0) | F.col(_UNSOUND))
    current = F.col(scd.CURRENT)
    zone, place = F.when(current, OPEN).otherwise(CLOSED), F.when(current, part).otherwise(_month(scd.TO))
    differing = written(zones.placed(sums, zone, place, F.col(_SIDE) < 0).drop(_SIDE), "differing-versions")
    require_empty(differing.filter(_UNSOUND).select(*dim.columns), "overlapping or several active versions of one key")
    differing = differing.drop(_UNSOUND)
    if first:
        for zone in (OPEN, CLOSED):
            layout.note_schema(zone, differing.select(*dim.columns).schema)
    zones.change(spark, root, layout, run, differing, [*dim.keys, scd.FROM])
    return zones.publish(spark, root, run, layout)


def feed_history(events: DataFrame, dim: Dimension = CITIES) -> DataFrame:
    """History from change events; a delete closes the version and opens none."""
    return scd.build_history(cdc.valid_operations(events), dim, F.col("operation") == cdc.DELETE)


def run_feed(spark: SparkSession, batch: DataFrame, silver_root: str, gold_root: str, buckets: int = BUCKETS) -> None:
    """Bring the latest-state table and the history table up to date with ``batch``.

    The history keeps the events it was built from, so late events and deletes
    of any batch end up in place. ``read`` gives it.
    """
    dim = CITIES
    first = not snapshots.exists(spark, silver_root)
    state = cdc.empty_state(batch, dim.keys, dim.tracked, dim.time, dim.tiebreak) if first else snapshots.read(spark, silver_root)
    snapshots.publish(cdc.apply_feed(state, batch, dim.keys, dim.tracked, dim.time, dim.tiebreak), silver_root)
    maintain(
        spark, cdc.valid_operations(batch), gold_root, dim, deleted=F.col("operation") == cdc.DELETE, extra=("operation",),
        buckets=buckets,
    )
