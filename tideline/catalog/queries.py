"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.catalog import inputs
from tideline.catalog.inputs import table
from tideline.functions.hashing import row_hash
from tideline.functions.scalars import money, money_out
from tideline.operators import cdc, dedup, joins, merge, partitions, scd, skew
from tideline.operators.joins import planned_bytes
from tideline.operators.ordered import SplitPolicy
from tideline.plans import dimensions, feeds, marts, medallion, sessions, skewjobs, streams
from tideline.plans.dimensions import CITIES, CUSTOMERS, PRODUCTS
from tideline.session import working_folder, written
from tideline.sinks import audit, compaction, evolution, layout, snapshots
from tideline.sources import incremental
from tideline.sources import tables as readers
from tideline.streaming import aggregates, progress
from tideline.streaming.sinks import state_partitions
from tideline.streaming.sources import event_time, table_stream

Query = Callable[[SparkSession, str], DataFrame]

INCREMENTAL_BOUNDARY = "2024-01-15 00:00:00"
REVENUE_BOUNDARY = "2001-06-01 00:00:00"
FEED_SPLIT = "1998-06-01 00:00:00"
LATE_NOW = "2000-01-01 00:00:00"
AS_OF = "1997-03-01 00:00:00"
SALTS = 8
FILES_PER_ARRIVAL, ARRIVING_FILE_BYTES = 2, 4 << 20
LATE_DELAY = "1 day"
# Buckets of the keys of a stored dimension; more of them suit larger tables.
FEW_BUCKETS = 8


# -- marts -----------------------------------------------------------------


def regional_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("amount"),
    )
    customers = inputs.with_region(table(spark, sf_dir, "customer"), spark, sf_dir, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"), "region"
    )
    return marts.regional_sales(lines, customers, inputs.products(spark, sf_dir))


def daily_txn_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_transaction_totals(inputs.transactions(spark, sf_dir))


def unreadable_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.unreadable_times(inputs.transactions(spark, sf_dir))


def top3_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_drivers(inputs.trips(spark, sf_dir), 3)


def session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.session_metrics(inputs.clicks(spark, sf_dir), inputs.products(spark, sf_dir))


def session_metrics_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.session_metrics(
        inputs.clicks(spark, sf_dir), inputs.products(spark, sf_dir), INCREMENTAL_BOUNDARY
    )


def _revenue_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        inputs.orders(spark, sf_dir), inputs.payments(spark, sf_dir), inputs.refunds(spark, sf_dir),
        inputs.rates(spark),
    )


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(*_revenue_inputs(spark, sf_dir))


def daily_revenue_last_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(*_revenue_inputs(spark, sf_dir), last_payment_only=True)


def daily_revenue_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue_since(*_revenue_inputs(spark, sf_dir), REVENUE_BOUNDARY)


def unrated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.unrated_orders(inputs.orders(spark, sf_dir), inputs.rates(spark))


def _order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.orders(spark, sf_dir).select("user_id", "amount", F.col("order_time").alias("event_time"))


def rolling_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rolling_features(_order_transactions(spark, sf_dir), inputs.users(spark, sf_dir))


def rolling_30_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rolling_features(_order_transactions(spark, sf_dir), inputs.users(spark, sf_dir), by_rows=True)


# -- incremental reads, deduplication, hashing -------------------------------


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.newer_than(inputs.clicks(spark, sf_dir), INCREMENTAL_BOUNDARY)


def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.next_boundary(inputs.clicks(spark, sf_dir))


def latest_by_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_per_key(inputs.clicks(spark, sf_dir), ["event_id"], ["ingestion_time"])


def latest_by_two_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_per_key(inputs.customer_updates(spark, sf_dir), ["customer_id"], CUSTOMERS.newest_first)


def dedup_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.one_per_key(inputs.transactions(spark, sf_dir), ["transaction_id"])


def dedup_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.one_per_key(
        inputs.customer_updates(spark, sf_dir), ["customer_id", "updated_at"], ["ingestion_time", "seq"]
    )


def row_hash_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", row_hash(customers, customers.columns, scale=2).alias("record_hash"))


# -- clean layer, merge, change feed -----------------------------------------


def silver_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.clean_sales(inputs.bronze_sales(spark, sf_dir))


def product_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active products as the stored table; the sales also bring products it lacks."""
    stored = inputs.products(spark, sf_dir).filter("is_active").select(
        "product_id", "price", F.lit(0).alias("units_sold"), F.lit(0).cast("bigint").alias("seq"),
        F.lit(0.0).alias("revenue"),
    )
    return medallion.merged_products(stored, medallion.clean_sales(inputs.bronze_sales(spark, sf_dir)))


def merge_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_clauses(spark, sf_dir, joins.BROADCAST_BYTES)


def merge_clauses_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge by one full outer join, as for a large source."""
    return _merged_clauses(spark, sf_dir, 0)


def _merged_clauses(spark: SparkSession, sf_dir: str, broadcast_limit: int) -> DataFrame:
    """Conditional update, delete and insert of one merge.

    Updates that lower a price are ignored, discontinued products are deleted,
    and unknown ones are inserted unless they are discontinued.
    """
    known = inputs.products(spark, sf_dir).filter("is_active").select("product_id", "category", "price")
    changes = inputs.product_versions(spark, sf_dir, raised=True).select(
        "product_id", "category", F.col("price").alias("new_price"),
        (F.col("product_id") % 17 == 0).alias("discontinued"),
    )
    return merge.merge(
        known, changes, ["product_id"],
        update={"price": "new_price"}, update_when=F.col("s.new_price") > F.col("t.price"),
        delete_when=F.col("s.discontinued"),
        insert={"product_id": "product_id", "category": "category", "price": "new_price"},
        insert_when=~F.col("s.discontinued"), broadcast_limit=broadcast_limit,
    )


def merge_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge whose values are an expression over both sides and a literal."""
    known = inputs.products(spark, sf_dir).filter("is_active").select("product_id", "category", "price")
    changes = inputs.product_versions(spark, sf_dir, raised=True).select("product_id", F.col("price").alias("new_price"))
    return merge.merge(
        known, changes, ["product_id"],
        update={"price": (F.col("t.price") + F.col("s.new_price")) / 2},
        insert={"product_id": "product_id", "category": F.lit("NEW"), "price": "new_price"},
    )


def merge_source_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.conflicting_keys(inputs.customer_updates(spark, sf_dir), ["customer_id"])


def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed in two batches, the second merged into the state after the first."""
    events = inputs.change_feed(spark, sf_dir)
    split = F.lit(FEED_SPLIT).cast("timestamp_ntz")
    state = cdc.empty_state(events, CITIES.keys, CITIES.tracked, CITIES.time, CITIES.tiebreak)
    for batch in (events.filter(F.col("event_time") < split), events.filter(F.col("event_time") >= split)):
        state = cdc.apply_feed(state, batch, CITIES.keys, CITIES.tracked, CITIES.time, CITIES.tiebreak)
    return cdc.live(state, CITIES.keys, CITIES.tracked)


def cdc_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.late_events(cdc.valid_operations(inputs.change_feed(spark, sf_dir)), LATE_NOW)


# -- versioned dimensions ----------------------------------------------------


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.customer_updates(spark, sf_dir)


def _stored_dimension(updates: DataFrame) -> DataFrame:
    """The dimension after the first load, as the stored table it is in a pipeline."""
    return _history_of(inputs.is_first_load(updates))


def _history_of(updates: DataFrame) -> DataFrame:
    """A dimension as the stored table it is in a pipeline."""
    return written(scd.build_history(updates, CUSTOMERS), "customers")


def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.initial_load(_updates(spark, sf_dir), CUSTOMERS)


def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    return scd.detect_changes(_stored_dimension(updates), inputs.is_next_batch(updates), CUSTOMERS)


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    return scd.apply_updates(_stored_dimension(updates), inputs.is_next_batch(updates), CUSTOMERS)


def scd2_apply_changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    return scd.apply_updates(
        _stored_dimension(updates), inputs.is_next_batch(updates), CUSTOMERS, insert_new=False
    )


def product_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = scd.initial_load(inputs.product_versions(spark, sf_dir, raised=False), PRODUCTS)
    return scd.apply_updates(stored, inputs.product_versions(spark, sf_dir, raised=True), PRODUCTS)


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.build_history(_updates(spark, sf_dir), CUSTOMERS)


def scd2_history_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history with a policy under which the largest keys of any table are cut into slices."""
    return scd.build_history(_updates(spark, sf_dir), CUSTOMERS, split=SplitPolicy(max_share=1e-6, min_rows=8))


def cdc_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.feed_history(inputs.change_feed(spark, sf_dir))


def scd2_late_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    return scd.late_updates(_history_of(inputs.is_on_time(updates)), inputs.is_behind(updates), CUSTOMERS)


def scd2_late_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    return scd.rebuild_from_log(
        _history_of(inputs.is_on_time(updates)), inputs.is_on_time(updates), inputs.is_behind(updates), CUSTOMERS
    )


def scd2_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _updates(spark, sf_dir)
    return scd.insert_late_versions(_history_of(inputs.is_on_time(updates)), inputs.is_behind(updates), CUSTOMERS)


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.as_of(_history_of(_updates(spark, sf_dir)), AS_OF)


def _faulty_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored dimension with every version of some customers reopened."""
    broken = F.col("customer_id") % 11 == 0
    return _history_of(_updates(spark, sf_dir)).withColumns({
        "is_current": broken | F.col("is_current"),
        "effective_to": F.when(~broken, F.col("effective_to")),
    })


def scd2_multi_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.multiple_active(_faulty_dimension(spark, sf_dir), CUSTOMERS.keys)


def scd2_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.overlapping(_faulty_dimension(spark, sf_dir), CUSTOMERS.keys)


# -- skew, joins, partitions -------------------------------------------------


def key_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.key_profile(inputs.skewed_events(spark, sf_dir), ["user_id"])


def top_key_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.top_key_share(inputs.skewed_events(spark, sf_dir), ["user_id"], 10)


def skew_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.skew_metrics(inputs.skewed_events(spark, sf_dir), ["user_id"], 10, "run-1")


def salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.salted_join(
        inputs.skewed_events(spark, sf_dir), inputs.users(spark, sf_dir), ["user_id"], ["event_id"]
    )


def heavy_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.heavy_key_join(
        inputs.skewed_events(spark, sf_dir), inputs.users(spark, sf_dir), ["user_id"], ["event_id"]
    )


def salted_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.skewed_events(spark, sf_dir).withColumn("amount", money("amount"))
    totals = skew.salted_totals(events, ["user_id"], ["event_id"], "amount", SALTS)
    return totals.withColumns({c: money_out(c) for c in ("total_amount", "min_amount", "max_amount")})


def broadcast_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return joins.dimension_join(events, inputs.users(spark, sf_dir), ["user_id"])


def partition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.skewed_events(spark, sf_dir)
    wide = partitions.by_count(events, 16)
    reports = partitions.partition_report(wide, "round robin").unionByName(
        partitions.partition_report(partitions.merge_down(wide, 4), "merged down")
    )
    return reports.select("layout", "partitions", "total_rows", (F.col("skew") < 1.5).alias("even"))


def composite_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.skewed_events(spark, sf_dir)
    reports = partitions.partition_report(partitions.by_keys(events, 8, ["user_id"]), "user").unionByName(
        partitions.partition_report(partitions.by_keys(events, 8, ["user_id", "event_id"]), "user and event")
    )
    # Where a key lands depends on the hash; whether one partition holds most rows does not.
    return reports.select("layout", "total_rows", (2 * F.col("max_rows") > F.col("total_rows")).alias("crowded"))


# -- sinks -------------------------------------------------------------------


def dynamic_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries of all dates, then corrected content of the later dates only."""
    path = working_folder(spark, "overwrite")
    dated = inputs.clicks(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))
    first = dedup.top_per_key(dated, ["event_id"], [], 1, then=["ingestion_time"]).drop("rank")
    layout.replace_partitions(first, path, ["event_date"])
    newest = dedup.latest_per_key(dated, ["event_id"], ["ingestion_time"])
    later = newest.filter(F.col("event_date") >= F.lit(INCREMENTAL_BOUNDARY).cast("timestamp_ntz").cast("date"))
    layout.replace_partitions(later, path, ["event_date"])
    return spark.read.parquet(path)


def schema_evolution_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inactive products without name first; the names come with the active ones."""
    path = working_folder(spark, "evolution")
    products = inputs.products(spark, sf_dir)
    layout.append(products.filter("not is_active").drop("product_name"), path)
    evolution.append_evolving(products.filter("is_active"), path)
    return evolution.read_evolved(spark, path)


def compact_and_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capped files, then compacted ones, then a layout sorted by user."""
    root = working_folder(spark, "compact")
    layout.overwrite(inputs.orders(spark, sf_dir), f"{root}/small", 5_000)
    layout.compact(spark, f"{root}/small", f"{root}/compact")
    layout.cluster(snapshots.read(spark, f"{root}/compact"), f"{root}/clustered", ["user_id", "order_time"])
    return snapshots.read(spark, f"{root}/clustered").withColumn("amount", money_out("amount"))


def curve_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders along a curve through user and time in 64 files: rows of one user, of one day, and whether few files are left for each."""
    root, orders = working_folder(spark, "curve"), inputs.orders(spark, sf_dir)
    layout.cluster(orders, root, ["user_id", "order_time"], 64)
    table, day = snapshots.read(spark, root), F.lit("1997-03-03 00:00:00").cast("timestamp_ntz")
    counts = table.agg(F.count_if(F.col("user_id") == 7).alias("one_user"), F.count_if(F.col("order_time") == day).alias("one_day"))
    few = {name: layout.files_left(table, column, value) for name, column, value in (("user", "user_id", 7), ("day", "order_time", day))}
    return counts.select("*", *[F.lit(2 * left <= files).alias(f"few_files_{name}") for name, (left, files) in few.items()])


def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of a large file and many small ones per currency: the large ones stay, the small ones become few."""
    path, orders = working_folder(spark, "files"), inputs.orders(spark, sf_dir)
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    layout.append(orders.filter(half == 0).repartition(1), path, ["currency"])
    large = compaction.data_files(spark, path)
    layout.append(orders.filter(half == 1).repartition(12), path, ["currency"])
    before = compaction.data_files(spark, path)
    target = 8 * max(f.size for f in large)
    replaced = compaction.compact(spark, path, target, small_share=min(f.size for f in large) / target)
    after = compaction.data_files(spark, path)
    return spark.read.parquet(path).groupBy("currency").agg(
        F.count(F.lit(1)).alias("order_rows"), money_out(F.sum("amount")).alias("amount"),
    ).select(
        "*", F.lit({f.path for f in large} <= {f.path for f in after}).alias("large_kept"),
        F.lit(replaced > 0 and 2 * len(after) < len(before)).alias("fewer_files"),
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "csv")
    inputs.transactions(spark, sf_dir).write.option("header", True).csv(path)
    return readers.csv(spark, path, marts.TRANSACTION_SCHEMA)


def named_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer updates through a format chosen by its name, with a given schema."""
    path, updates = working_folder(spark, "orc"), inputs.customer_updates(spark, sf_dir)
    updates.write.format("orc").save(path)
    return readers.load(spark, "orc", path, updates.schema)


# -- streams -----------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a glob, the path may be one file or a folder of files.
    return table_stream(spark, f"{sf_dir}/events.parque[t]", table(spark, sf_dir, "events").schema)


def _paced_event_stream(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """The events as files that arrive one after the other, in the order of time, one file per micro-batch."""
    events, folder = table(spark, sf_dir, "events"), working_folder(spark, "arriving")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(at, [i / batches for i in range(1, batches)], 1000)).first()[0]
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = events.filter((F.lit(True) if low is None else at >= low) & (F.lit(True) if high is None else at < high))
        part.write.mode("append").parquet(folder)
    files = len(spark.read.parquet(folder).inputFiles())
    return table_stream(spark, folder, events.schema, maxFilesPerTrigger=max(1, files // batches))


def _state_partitions(spark: SparkSession, sf_dir: str) -> int:
    return state_partitions(table(spark, sf_dir, "events"))


def _timed_events(spark: SparkSession, sf_dir: str, source=_event_stream) -> DataFrame:
    stream = source(spark, sf_dir).select("user_id", F.col("ts").alias("event_timestamp"))
    return event_time(stream, "event_timestamp")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream as a message topic, re-deliveries included."""
    return inputs.clicks_from(_paced_event_stream(spark, sf_dir)).select(
        F.to_json(F.struct(
            F.col("event_id").alias("transaction_id"), F.col("user_id").alias("merchant_id"), "user_id", "amount",
            "event_time", "ingestion_time",
        )).cast("binary").alias("value")
    )


def stream_hourly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = working_folder(spark, "hourly")
    metrics = streams.merchant_metrics(_messages(spark, sf_dir))
    return streams.upsert_run(spark, metrics, root, ["merchant_id"], state_partitions=_state_partitions(spark, sf_dir))


def stream_sliding_14d(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = working_folder(spark, "sliding")
    activity = streams.activity_14d(_timed_events(spark, sf_dir, _paced_event_stream))
    return streams.upsert_run(spark, activity, root, ["user_id"], state_partitions=_state_partitions(spark, sf_dir))


def stream_sliding_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = working_folder(spark, "sliding")
    activity = streams.activity_7d(_timed_events(spark, sf_dir))
    return streams.upsert_run(spark, activity, root, ["user_id"], state_partitions=_state_partitions(spark, sf_dir))


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = aggregates.session_counts(_timed_events(spark, sf_dir), ["user_id"], "event_timestamp", "6 hours", "1 day")
    return streams.append_run(
        spark, aggregates.flat_window(sessions, "session_window"), working_folder(spark, "sessions"), _state_partitions(spark, sf_dir)
    )


def stream_preagg_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over growing input; the second refreshes only the sums that its users and days show in."""
    root, events = working_folder(spark, "daily"), table(spark, sf_dir, "events")
    split = F.lit(INCREMENTAL_BOUNDARY).cast("timestamp_ntz")
    for arrived in (events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split)):
        layout.append(arrived, f"{root}/arriving")
        stream = table_stream(spark, f"{root}/arriving", events.schema).select("user_id", F.col("ts").alias("event_timestamp"))
        daily = aggregates.daily_counts(event_time(stream, "event_timestamp"), ["user_id"], "event_timestamp", "2 days")
        rolled = streams.roll_up_run(spark, aggregates.flat_window(daily), root, state_partitions=_state_partitions(spark, sf_dir))
    return rolled


def stream_late_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries in the order they arrive, a micro-batch per three days; rows that came after the watermark, as noted on the way."""
    root, clicks = working_folder(spark, "late"), inputs.clicks(spark, sf_dir)
    edges = [F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz") for day in range(4, 32, 3)]
    at, states = F.col("ingestion_time"), _state_partitions(spark, sf_dir)
    # Sorted out once; an arrival then has more files, for more tasks, the larger the table is.
    arrival = sum([F.when(at >= edge, 1).otherwise(0) for edge in edges], F.lit(0)).alias("arrival")
    layout.append(clicks.filter(at.isNotNull()).select("*", arrival), f"{root}/sorted", ["arrival"])
    arrivals = spark.read.schema(T.StructType([*clicks.schema, T.StructField("arrival", T.IntegerType())])).parquet(f"{root}/sorted")
    files = max(FILES_PER_ARRIVAL, math.ceil(planned_bytes(arrivals) / (ARRIVING_FILE_BYTES * (len(edges) + 1))))
    for number in range(len(edges) + 1):
        part = arrivals.filter(F.col("arrival") == number).drop("arrival")
        layout.append(part.repartition(files), f"{root}/arriving")
    stream = table_stream(spark, f"{root}/arriving", clicks.schema, maxFilesPerTrigger=files)
    once = aggregates.distinct_events(event_time(stream, "event_time"), ["event_id"], "event_time", LATE_DELAY)
    streams.watched_run(spark, once, root, states)
    return progress.late_drops(spark, f"{root}/progress").select("input_rows", "late_rows_dropped")


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _timed_events(spark, sf_dir).withWatermark("event_timestamp", "2 hours")
    hourly = events.groupBy(F.window("event_timestamp", "1 hour"), "user_id").agg(F.count(F.lit(1)).alias("event_count"))
    return streams.append_run(spark, aggregates.flat_window(hourly), working_folder(spark, "append"), _state_partitions(spark, sf_dir))


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published stream totals per merchant beside a batch count of distinct events."""
    published = audit.totals(stream_hourly_metrics(spark, sf_dir), ["merchant_id"], total_txn="txn_count")
    newest = dedup.latest_per_key(inputs.clicks(spark, sf_dir), ["event_id"], ["ingestion_time"])
    recomputed = newest.groupBy(F.col("user_id").alias("merchant_id")).agg(F.count(F.lit(1)).alias("total_txn"))
    return audit.compare(published, recomputed, ["merchant_id"], "total_txn")


def stream_activity_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity features as an append-only feed: each window once, when it has closed."""
    activity = streams.activity_14d(_timed_events(spark, sf_dir))
    return streams.append_run(spark, activity, working_folder(spark, "activity"), _state_partitions(spark, sf_dir))


# -- whole pipelines: read, publish, read back --------------------------------


def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing source; the stored boundary lets each row through once."""
    root = working_folder(spark, "incremental")
    source = inputs.clicks(spark, sf_dir)
    earlier = source.filter(F.col("ingestion_time") <= F.lit(INCREMENTAL_BOUNDARY).cast("timestamp_ntz"))
    for arrived in (earlier, source):
        incremental.run_incremental(spark, arrived, f"{root}/control", f"{root}/table")
    return incremental.read_published(spark, f"{root}/table", source.schema)


def incremental_boundary_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals by whole days: half of the boundary day comes after it was read, some rows have no time, a run is repeated."""
    root, boundary = working_folder(spark, "boundary"), F.lit(INCREMENTAL_BOUNDARY).cast("timestamp_ntz")
    daily = inputs.clicks(spark, sf_dir).withColumn("ingestion_time", F.when(
        F.col("event_id").cast("bigint") % 50 != 0, F.to_date("ingestion_time").cast("timestamp_ntz")
    ))
    at = F.col("ingestion_time")
    earlier = daily.filter((at < boundary) | ((at == boundary) & (F.col("event_id").cast("bigint") % 2 == 0)))
    for arrived in (earlier, earlier, daily):
        incremental.run_incremental(spark, arrived, f"{root}/control", f"{root}/table")
    return incremental.read_published(spark, f"{root}/table", daily.schema)


def daily_revenue_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What had arrived at the boundary is published by date; then the dates that later arrivals touch are replaced."""
    path = working_folder(spark, "revenue")
    *facts, rates = _revenue_inputs(spark, sf_dir)
    at = F.lit(REVENUE_BOUNDARY).cast("timestamp_ntz")
    marts.publish_daily_revenue(*[f.filter(F.col("ingestion_time") <= at) for f in facts], rates, path)
    marts.publish_daily_revenue(*facts, rates, path, REVENUE_BOUNDARY)
    return marts.published_daily_revenue(spark, path)


def session_metrics_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions as of the boundary are published by date; then later arrivals change some and move others to another date."""
    root = working_folder(spark, "sessions")
    clicks, products = inputs.moving_clicks(spark, sf_dir), inputs.products(spark, sf_dir)
    at = F.lit(INCREMENTAL_BOUNDARY).cast("timestamp_ntz")
    sessions.publish(clicks.filter(F.col("ingestion_time") <= at), products, root, buckets=FEW_BUCKETS)
    sessions.publish(clicks, products, root, INCREMENTAL_BOUNDARY)
    return sessions.read(spark, root)


def product_table_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load from the sales of odd order lines, then a merge of all of them."""
    root = working_folder(spark, "products")
    bronze = inputs.bronze_sales(spark, sf_dir)
    medallion.run(spark, bronze.filter(F.col("seq") % 2 == 1), f"{root}/silver", f"{root}/gold")
    medallion.run(spark, bronze, f"{root}/silver", f"{root}/gold")
    return snapshots.read(spark, f"{root}/gold")


def customer_dimension_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load, then one batch with new, changed and late rows; checked before each publish."""
    root = working_folder(spark, "customers")
    updates = _updates(spark, sf_dir)
    dimensions.maintain(spark, inputs.is_first_load(updates), root, CUSTOMERS, buckets=FEW_BUCKETS)
    dimensions.maintain(spark, inputs.is_next_batch(updates), root, CUSTOMERS)
    return dimensions.read(spark, root)


def customer_dimension_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published dimension at one moment, from the months that end after it; the updates came in four batches."""
    root = working_folder(spark, "customers")
    for quarter in range(4):
        batch = _updates(spark, sf_dir).filter(F.pmod(F.xxhash64("seq"), F.lit(4)) == quarter)
        dimensions.maintain(spark, batch, root, CUSTOMERS, buckets=FEW_BUCKETS)
    return dimensions.read_as_of(spark, root, AS_OF)


def change_feed_silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state after the feed in two batches, each with older events than the other, and the first once more."""
    feed = inputs.change_feed(spark, sf_dir)
    root, args = working_folder(spark, "silver"), (CITIES.keys, CITIES.tracked, CITIES.time, CITIES.tiebreak)
    even, odd = feed.filter(F.col("seq") % 2 == 0), feed.filter(F.col("seq") % 2 == 1)
    state = cdc.empty_state(feed, *args)
    for batch in (even, odd, even):
        snapshots.publish(cdc.apply_feed(state, batch, *args), root)
        state = snapshots.read(spark, root)
    return cdc.live(state, CITIES.keys, CITIES.tracked)


def change_feed_retention_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state with deletes kept for 400 days: four batches in time, each with a replay of the one before, then the first year once more."""
    feed, root = inputs.change_feed(spark, sf_dir), working_folder(spark, "retention")
    year = F.year("event_time")
    for first, last in ((1995, 1996), (1997, 1998), (1999, 1999), (2000, 2010)):
        replayed = (year == first - 1) & (F.month("event_time") > 6)
        feeds.advance(spark, feed.filter(year.between(first, last) | replayed), root, CITIES, "400 days", FEW_BUCKETS)
    feeds.advance(spark, feed.filter(year == 1995), root, CITIES, "400 days")
    return feeds.live(spark, root, CITIES)


def change_feed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in two batches of which each has events older than the other's."""
    root = working_folder(spark, "feed")
    feed = inputs.change_feed(spark, sf_dir)
    even, odd = feed.filter(F.col("seq") % 2 == 0), feed.filter(F.col("seq") % 2 == 1)
    dimensions.run_feed(spark, even, f"{root}/silver", f"{root}/gold", FEW_BUCKETS)
    dimensions.run_feed(spark, odd, f"{root}/silver", f"{root}/gold")
    return dimensions.read(spark, f"{root}/gold")


def _dated_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.skewed_events(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))


def skew_safe_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "joined")
    skewjobs.skew_safe(
        _dated_fact(spark, sf_dir), inputs.users(spark, sf_dir), ["user_id"], ["event_id"], "event_date", path
    )
    return spark.read.parquet(path)


def tuned_join_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "joined")
    skewjobs.tuned(_dated_fact(spark, sf_dir), inputs.users(spark, sf_dir), ["user_id"], ["event_id"], path)
    return spark.read.parquet(path)


def tuned_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same output by the plan for a dimension that is too large to broadcast: heavy keys salted by their weight."""
    path = working_folder(spark, "joined")
    fact, users = _dated_fact(spark, sf_dir), inputs.users(spark, sf_dir)
    skewjobs.tuned(fact, users, ["user_id"], ["event_id"], path, 0, max(1, planned_bytes(fact) // 16))
    return spark.read.parquet(path)


def skew_metrics_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a join and a repeat of the second: each run's skew is noted by the pass that writes its output, once."""
    root, users = working_folder(spark, "metered"), inputs.users(spark, sf_dir)
    fact = _dated_fact(spark, sf_dir)
    early = fact.filter(F.col("event_time") < F.lit(INCREMENTAL_BOUNDARY).cast("timestamp_ntz"))
    for rows, run_id in ((early, "run-1"), (early, "run-2"), (fact, "run-2")):
        skewjobs.skew_safe(rows, users, ["user_id"], ["event_id"], "event_date", f"{root}/joined", f"{root}/metrics", run_id)
    return skew.metrics(spark, f"{root}/metrics")


def flat_join_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "joined")
    skewjobs.flat(_dated_fact(spark, sf_dir), inputs.users(spark, sf_dir), ["user_id"], path)
    return spark.read.parquet(path)


ALL: tuple[Query, ...] = (
    regional_sales, daily_txn_totals, unreadable_times, top3_drivers, session_metrics, session_metrics_incremental,
    daily_revenue, daily_revenue_last_payment, daily_revenue_since, daily_revenue_run, session_metrics_run, unrated_orders, rolling_30d, rolling_30_rows,
    incremental_events, next_watermark, latest_by_ingestion, latest_by_two_times, dedup_single_key, dedup_composite,
    row_hash_customers, silver_revenue, product_upsert, merge_clauses, merge_clauses_shuffled, merge_expressions, merge_source_conflicts, cdc_latest_state,
    cdc_late_events, scd2_initial, scd2_changes, scd2_apply, scd2_apply_changed_only, product_scd2, scd2_history, scd2_history_sliced,
    cdc_scd2_history, scd2_late_detect, scd2_late_fix, scd2_late_split, scd2_as_of, scd2_multi_active, scd2_overlaps,
    key_profile, top_key_share, skew_metrics, salted_join, heavy_key_join, salted_agg, broadcast_join,
    partition_report, composite_repartition, dynamic_overwrite_roundtrip, schema_evolution_roundtrip,
    compact_and_cluster, curve_pruning, compact_small_files, csv_roundtrip, named_format_roundtrip, stream_hourly_metrics, stream_sliding_14d, stream_sliding_7d,
    stream_sessions, stream_preagg_rollup, stream_append, stream_late_drops, stream_audit,
    stream_activity_append, incremental_run, incremental_boundary_run, product_table_run, customer_dimension_run, customer_dimension_as_of, change_feed_silver_run, change_feed_retention_run, change_feed_run,
    skew_safe_output, tuned_join_output, tuned_join_salted, skew_metrics_run, flat_join_output,
)


def _in_utc(query: Query) -> Query:
    """Event times in the given tables carry no zone; streams read them in the session's."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def registered() -> dict[str, Query]:
    return {query.__name__: _in_utc(query) for query in ALL}
