"""Incremental reads bounded by ingestion time.

The boundary is kept in a small control table. It moves only after the output
has been committed. A run writes parts that are named by the boundary it starts
from, so a failed run is repeated and replaces what it had written. More rows
may still arrive with the latest time seen: they stay in a part of their own
that the next run reads again. Rows without a time are a part as well.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import moment
from tideline.sinks import snapshots


def newer_than(df: DataFrame, boundary: datetime | str | None, time: str = "ingestion_time") -> DataFrame:
    """Rows that arrived after ``boundary``; the filter reaches the Parquet scan."""
    if boundary is None:
        return df
    return df.filter(F.col(time) > moment(boundary, df.schema[time].dataType))


def next_boundary(df: DataFrame, time: str = "ingestion_time") -> DataFrame:
    """One row: the latest arrival, the boundary of the next run."""
    return df.agg(F.max(time).alias("boundary"))


def stored_boundary(spark: SparkSession, control: str) -> datetime | None:
    if not snapshots.exists(spark, control):
        return None
    return snapshots.read(spark, control).first()["boundary"]


def run_incremental(
    spark: SparkSession, source: DataFrame, control: str, root: str, time: str = "ingestion_time",
) -> datetime | None:
    """Publish below ``root`` what arrived from the stored boundary on, then store the new boundary.

    Rows up to the latest time of the run (not including it) are closed for good.
    Returns the new boundary.
    """
    boundary, kind = stored_boundary(spark, control), source.schema[time].dataType
    batch = source if boundary is None else source.filter(F.col(time) >= moment(boundary, kind))
    upper = next_boundary(batch, time).first()["boundary"]
    source.filter(F.col(time).isNull()).write.mode("overwrite").parquet(f"{root}/untimed")
    if upper is None:
        return boundary
    name = "start" if boundary is None else re.sub(r"\W", "-", str(boundary))
    at = moment(upper, kind)
    batch.filter(F.col(time) < at).write.mode("overwrite").parquet(f"{root}/closed/{name}")
    batch.filter(F.col(time) == at).write.mode("overwrite").parquet(f"{root}/latest")
    snapshots.publish(spark.range(1).select(at.alias("boundary")), control)
    return upper


def read_published(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows published so far."""
    return spark.read.schema(schema).parquet(f"{root}/closed/*", f"{root}/latest", f"{root}/untimed")
