"""Stream sinks and runs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.joins import planned_bytes
from tideline.operators.merge import upsert
from tideline.sinks.layout import replace_partitions

DAY = "window_date"
#: Files that fill a state partition, and the least number of those: each costs every batch a task and files, however few its rows.
STATE_BYTES, LEAST_STATE_PARTITIONS = 4 << 20, 8


def state_partitions(source: DataFrame) -> int:
    """State partitions for a stream over the rows of ``source``: by the size of its files, at most the configured number."""
    configured = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(configured, max(LEAST_STATE_PARTITIONS, math.ceil(planned_bytes(source) / STATE_BYTES)))


@contextmanager
def start_settings(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings that a stream takes over when it starts, restored afterwards.

    A stream keeps the number of state partitions it starts with for good, so it
    is what the caller names or the session has configured, never a guess from
    the executors that happen to be there. Sessions of one key are merged inside
    each map task, so a hot key sends few rows.
    """
    partitions = "spark.sql.shuffle.partitions"
    merge_first = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = {key: spark.conf.get(key) for key in (partitions, merge_first)}
    if state_partitions:
        spark.conf.set(partitions, str(state_partitions))
    spark.conf.set(merge_first, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def append_to(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append finished windows. The file sink logs its batches, so a replay adds nothing."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).format("parquet").start(path)


def has_content(spark: SparkSession, path: str) -> bool:
    """Whether the path is there and, as a folder, holds anything."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(folder) and len(fs.listStatus(folder)) > 0


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def window_upsert(path: str, staging: str, keys: Sequence[str], changed: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: upsert window totals by ``window_start`` and ``keys``.

    With ``changed``, each batch leaves there which keys and days it touched.

    The target is partitioned by the day a window starts on. A batch touches few
    days, and only those are merged and replaced. The merged days are written to
    a staging folder of the batch first, because the target cannot be overwritten
    while it is read. If a crash left the target half replaced, the replay finds
    the finished merge (its success marker) and publishes that as it stands,
    instead of merging with a target that lacks rows.
    """

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        incoming = batch.withColumn(DAY, F.to_date("window_start"))
        step = f"{staging}/batch-{batch_id}"
        if has_content(spark, f"{step}/merged/_SUCCESS"):
            replace_partitions(spark.read.parquet(f"{step}/merged"), path, [DAY])
            return
        incoming.write.mode("overwrite").parquet(f"{step}/incoming")
        incoming = spark.read.schema(incoming.schema).parquet(f"{step}/incoming")
        if incoming.isEmpty():
            return
        if changed:
            incoming.select(*keys, DAY).distinct().write.mode("overwrite").parquet(f"{changed}/batch={batch_id}")
        merged = incoming
        if has_content(spark, path):
            days = incoming.select(DAY).distinct()
            target = spark.read.schema(incoming.schema).parquet(path).join(days, DAY, "left_semi")
            merged = upsert(target.select(*incoming.columns), incoming, ["window_start", *keys], unique=True)
        merged.write.mode("overwrite").parquet(f"{step}/merged")
        replace_partitions(spark.read.parquet(f"{step}/merged"), path, [DAY])
        remove(spark, f"{staging}/batch-{batch_id - 2}")  # only the last batch can be replayed

    return upsert_batch


def upsert_to(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], once: bool = True, changed: str | None = None
) -> StreamingQuery:
    """Keep ``path`` at the latest totals of a flat windowed aggregate (update mode)."""
    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(window_upsert(path, f"{checkpoint}-staging", keys, changed))
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a run over the available data to end; a failed stream raises here."""
    query.awaitTermination()
