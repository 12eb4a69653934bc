"""Mutable tables as a row of complete snapshots.

A Parquet path cannot be replaced while a query reads it. Each publish writes a
new folder; the newest folder with the writer's success marker is the table. An
aborted write has no marker and is never seen. One writer at a time is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"^snapshot-(\d{9})$")


def _numbers(spark: SparkSession, root: str, complete: bool) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        match = _NAME.match(status.getPath().getName())
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if match and (not complete or fs.exists(marker)):
            found.append(int(match.group(1)))
    return sorted(found)


def folder(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/snapshot-{number:09d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete snapshots, oldest first."""
    return _numbers(spark, root, complete=True)


def next_number(spark: SparkSession, root: str) -> int:
    """The number that the next publish takes; one that an aborted write used is not taken again."""
    known = _numbers(spark, root, complete=False)
    return known[-1] + 1 if known else 1


def exists(spark: SparkSession, root: str) -> bool:
    """Whether the table has been loaded before: choose first load or merge by it."""
    return bool(versions(spark, root))


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    chosen = known[-1] if number is None else number
    if chosen not in known:
        raise FileNotFoundError(f"no complete snapshot {chosen} under {root}")
    return spark.read.parquet(folder(root, chosen))


def publish(
    df: DataFrame, root: str, partition_by: tuple[str, ...] = (), max_records_per_file: int = 0,
    check: Callable[[DataFrame], None] | None = None,
) -> int:
    """Write the new content of the table; returns its snapshot number.

    With a ``check`` the files are written without marker and read back by it.
    The marker follows once the check has passed, so readers never see content
    that fails, and the plan of ``df`` runs only once.
    """
    spark = df.sparkSession
    number = next_number(spark, root)
    path = folder(root, number)
    writer = df.write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if check is None:
        writer.parquet(path)
        return number
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    check(spark.read.schema(df.schema).parquet(path))
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker).close()
    return number
