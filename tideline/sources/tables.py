"""Batch table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load(spark: SparkSession, fmt: str, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Any installed format by name."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Text table with a header. The schema is given, so the file is read once."""
    return spark.read.schema(schema).option("header", True).csv(path)
