"""Additive schema evolution on append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sinks.layout import append


class SchemaConflict(Exception):
    pass


def aligned(df: DataFrame, stored: T.StructType) -> DataFrame:
    """``df`` in the stored column order: missing columns as typed nulls, new ones last.

    A column that changed its type is refused; readers would break on it.
    """
    known = {f.name: f.dataType for f in stored.fields}
    for field in df.schema.fields:
        if field.name in known and known[field.name] != field.dataType:
            raise SchemaConflict(
                f"{field.name}: stored {known[field.name].simpleString()}, got {field.dataType.simpleString()}"
            )
    old = [
        F.col(n) if n in df.columns else F.lit(None).cast(kind).alias(n) for n, kind in known.items()
    ]
    return df.select(*old, *[c for c in df.columns if c not in known])


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Read with the union of all file schemas."""
    return spark.read.option("mergeSchema", True).parquet(path)


def append_evolving(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    append(aligned(df, read_evolved(df.sparkSession, path).schema), path, partition_by)
