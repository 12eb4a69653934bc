"""Output writers and file layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.partitions import balanced, clustered, curve_clustered
from tideline.session import written
from tideline.sinks import snapshots


# Fixed value: the folder name of rows without a partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def overwrite(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], max_records_per_file: int = 0
) -> None:
    """Replace the partitions present in ``df`` and leave all others untouched.

    Rows are grouped by partition value, so a small partition is one file. A
    large one is split to the advisory size: with one writer per value a day
    that holds a third of the rows would be one task.
    """
    (
        balanced(df, *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def clear_partitions(spark: SparkSession, path: str, column: str, values: DataFrame) -> None:
    """Remove the partitions of ``values``, a frame of one column with few rows (dates that have no rows any more)."""
    for row in values.select(F.col(column).cast("string")).toLocalIterator():
        name = NULL_PARTITION if row[0] is None else row[0]
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_within(
    spark: SparkSession, content: DataFrame, path: str, column: str, gone: DataFrame, max_records_per_file: int = 0
) -> None:
    """Replace the partitions by ``column`` that ``content`` has, and remove those of ``gone`` that it lacks.

    ``content`` may come from the table itself: it is written aside first.
    """
    staged = written(content, "replacement")
    replace_partitions(staged, path, [column], max_records_per_file)
    empty = gone.select(column).distinct().join(
        staged.select(F.col(column).alias("__kept")).distinct(), F.col(column).eqNullSafe(F.col("__kept")), "left_anti"
    )
    clear_partitions(spark, path, column, empty)


def compact(spark: SparkSession, path: str, root: str, partition_by: tuple[str, ...] = ()) -> int:
    """Rewrite many small files as few of the advisory size, published as a new snapshot."""
    table = spark.read.parquet(path)
    return snapshots.publish(balanced(table, *partition_by), root, partition_by)


def cluster(
    df: DataFrame, root: str, keys: Sequence[str], files: int | None = None, max_records_per_file: int = 0
) -> int:
    """Write so that a filter on any of ``keys`` skips most files: sorted by one key, or along a curve through several."""
    laid = clustered(df, keys, files) if len(keys) == 1 else curve_clustered(df, keys, files)
    return snapshots.publish(laid, root, max_records_per_file=max_records_per_file)


def files_left(table: DataFrame, column: str, value) -> tuple[int, int]:
    """Files that a filter ``column = value`` leaves by the least and greatest value of each, and all files."""
    spans = table.groupBy(F.input_file_name()).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    inside = F.lit(value).between(F.col("low"), F.col("high"))
    found = spans.agg(F.count_if(inside).alias("left"), F.count(F.lit(1)).alias("files")).first()
    return found["left"], found["files"]
