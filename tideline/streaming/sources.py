"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_stream(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Files of a table folder, or of a glob, as a stream of new files."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """A topic as a stream; needs the public Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )


def parse_messages(messages: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Message bytes to columns. Text that is no JSON gives a row of nulls, not an error."""
    return messages.select(F.from_json(F.col(value).cast("string"), schema).alias("data")).select("data.*")


def event_time(df: DataFrame, column: str) -> DataFrame:
    """A watermark needs a zoned timestamp; zone-less ones are read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
