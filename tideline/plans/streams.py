"""Stream pipelines over one run of the available data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tideline.operators.joins import rows_of
from tideline.operators.rolling import rolling_days
from tideline.session import written
from tideline.sinks.layout import replace_within
from tideline.streaming import aggregates, sinks
from tideline.streaming.progress import ProgressTable
from tideline.streaming.sources import parse_messages

# Message schema of the payment stream, and the delays and windows
# of the three published stream features.
MESSAGE_SCHEMA = (
    "transaction_id string, merchant_id string, user_id string, amount double, "
    "event_time timestamp, ingestion_time timestamp"
)
HOURLY_DELAY, HOURLY_WINDOW = "2 hours", "1 hour"
ACTIVITY_DELAY, ACTIVITY_WINDOW = "2 days", "14 days"
WEEKLY_DELAY, WEEKLY_WINDOW = "1 day", "7 days"
SLIDE = "1 day"
ACTIVITY_DAYS = 14


def merchant_metrics(messages: DataFrame) -> DataFrame:
    """Hourly metrics per merchant from raw messages, each transaction counted once."""
    events = parse_messages(messages, MESSAGE_SCHEMA)
    once = aggregates.distinct_events(events, ["transaction_id"], "event_time", HOURLY_DELAY)
    return aggregates.flat_window(
        aggregates.amount_metrics(once, ["merchant_id"], "event_time", "amount", HOURLY_WINDOW)
    )


def activity_14d(events: DataFrame) -> DataFrame:
    return aggregates.flat_window(
        aggregates.sliding_counts(events, ["user_id"], "event_timestamp", ACTIVITY_WINDOW, SLIDE, ACTIVITY_DELAY)
    )


def activity_7d(events: DataFrame) -> DataFrame:
    return aggregates.flat_window(
        aggregates.sliding_counts(events, ["user_id"], "event_timestamp", WEEKLY_WINDOW, SLIDE, WEEKLY_DELAY)
    )


def upsert_run(
    spark: SparkSession, stream: DataFrame, root: str, keys: list[str], changed: str | None = None, state_partitions: int | None = None,
) -> DataFrame:
    """Upsert everything available into ``root/table`` and return the table. ``state_partitions`` counts for the first run."""
    schema = stream.schema
    with sinks.start_settings(spark, state_partitions):
        query = sinks.upsert_to(stream, f"{root}/table", f"{root}/checkpoint", keys, changed=changed)
    sinks.finish(query)
    if not sinks.has_content(spark, f"{root}/table"):  # a stream without rows
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, StructField(sinks.DAY, DateType())])
    return spark.read.schema(stored).parquet(f"{root}/table").select(*schema.names)


def append_run(spark: SparkSession, stream: DataFrame, root: str, state_partitions: int | None = None) -> DataFrame:
    """Append all finished windows to ``root/table`` and return the table."""
    schema = stream.schema
    with sinks.start_settings(spark, state_partitions):
        query = sinks.append_to(stream, f"{root}/table", f"{root}/checkpoint")
    sinks.finish(query)
    return spark.read.schema(schema).parquet(f"{root}/table")


def watched_run(spark: SparkSession, stream: DataFrame, root: str, state_partitions: int | None = None) -> DataFrame:
    """``append_run`` that leaves a row per progress event below ``root/progress``."""
    schema, watch = stream.schema, ProgressTable(spark, f"{root}/progress")
    spark.streams.addListener(watch)
    try:
        with sinks.start_settings(spark, state_partitions):
            query = sinks.append_to(stream, f"{root}/table", f"{root}/checkpoint")
        sinks.finish(query)
        watch.wait(query)
    finally:
        spark.streams.removeListener(watch)
    return spark.read.schema(schema).parquet(f"{root}/table")


def roll_up(daily: DataFrame, days: int = ACTIVITY_DAYS) -> DataFrame:
    """Counts over the last ``days`` days from streamed daily counts."""
    dated = daily.select("user_id", F.to_date("window_start").alias("event_date"), "event_count")
    return rolling_days(dated, ["user_id"], "event_date", days, {"rolling_count": "event_count"})


def rolled_up(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rolled")


def roll_up_run(
    spark: SparkSession, daily: DataFrame, root: str, days: int = ACTIVITY_DAYS, state_partitions: int | None = None
) -> DataFrame:
    """Upsert streamed daily counts of users, then refresh the roll-up of what changed; returns the roll-up.

    A changed day of a user shows in the sums of that day and of the following
    ``days - 1``. Only these are computed again, from the days that their
    windows hold, and only dates among them are replaced. The notes of what
    changed are removed last: a run that stopped before is repeated.
    """
    changed = f"{root}/changed"
    upsert_run(spark, daily, root, ["user_id"], changed, state_partitions)
    if not sinks.has_content(spark, changed):
        return rolled_up(spark, root)
    touched = written(spark.read.parquet(changed).select("user_id", F.col(sinks.DAY).alias("event_date")).distinct(), "changed-days")
    low, high = touched.agg(F.min("event_date"), F.max("event_date")).first()
    reach = F.explode(F.expr(f"sequence(event_date, date_add(event_date, {days - 1}))")).alias("event_date")
    reach = written(touched.select("user_id", reach).distinct(), "changed-sums")
    stored = spark.read.parquet(f"{root}/table").filter(F.col(sinks.DAY).between(
        F.date_add(F.lit(low), 1 - days), F.date_add(F.lit(high), days - 1)
    ))
    own = rows_of(stored, touched.select("user_id").distinct(), ["user_id"])
    content = rows_of(roll_up(own, days), reach, ["user_id", "event_date"])
    dates = reach.select("event_date").distinct()
    if sinks.has_content(spark, f"{root}/rolled"):
        kept = rolled_up(spark, root).filter(F.col("event_date").between(F.lit(low), F.date_add(F.lit(high), days - 1)))
        kept = rows_of(rows_of(kept, dates, ["event_date"]), reach, ["user_id", "event_date"], "left_anti")
        content = kept.select(*content.columns).unionByName(content)
    replace_within(spark, content, f"{root}/rolled", "event_date", dates)
    sinks.remove(spark, changed)
    return rolled_up(spark, root)
