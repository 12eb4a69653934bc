"""Batch marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import count_where, differs, money, money_out, money_total, parse_timestamp
from tideline.operators.dedup import latest_per_key, one_per_key, top_per_key
from tideline.operators.joins import dimension_join, rows_of, sum_before_join
from tideline.operators.rolling import daily_totals, rolling_days, rolling_rows
from tideline.session import written
from tideline.sinks.layout import replace_partitions, replace_within
from tideline.sources.incremental import newer_than

# Column types of the daily transaction file, length of the rolling
# features, tolerance of the payment check.
TRANSACTION_SCHEMA = (
    "transaction_id string, user_id string, amount double, transaction_type string, transaction_timestamp string"
)
FEATURE_DAYS = 30
MISMATCH_TOLERANCE = 0.01
MONTH = "order_month"


def regional_sales(lines: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per region of ``lines(customer_id, product_id, amount)``.

    Sales are summed per customer before the customer join, so that join moves
    one row per customer. ``customers`` has ``customer_id`` and ``region``.
    """
    known = dimension_join(lines, products.select("product_id"), ["product_id"], "left_semi")
    per_customer = sum_before_join(known, ["customer_id"], amount=money("amount"))
    return (
        per_customer.join(customers, "customer_id")
        .groupBy("region")
        .agg(money_out(F.sum("amount")).alias("total_sales"))
    )


def daily_transaction_totals(transactions: DataFrame) -> DataFrame:
    """Total per day and type of valid transactions; unreadable times form a null day."""
    return (
        one_per_key(transactions, ["transaction_id"])
        .filter(F.col("amount") > 0)
        .withColumn("transaction_date", F.to_date(parse_timestamp("transaction_timestamp")))
        .groupBy("transaction_date", "transaction_type")
        .agg(money_out(F.sum(money("amount"))).alias("total_amount"))
    )


def unreadable_times(transactions: DataFrame) -> DataFrame:
    """Rejected rows to look at: a time is given but cannot be read."""
    given = F.col("transaction_timestamp")
    return transactions.filter(given.isNotNull() & parse_timestamp(given).isNull())


def top_drivers(trips: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` drivers per city and day with the highest fares, ties by driver."""
    per_driver = (
        latest_per_key(trips, ["trip_id"], ["trip_timestamp", "seq", "fare_amount"])
        .groupBy("city", F.to_date("trip_timestamp").alias("trip_date"), "driver_id")
        .agg(F.sum(money("fare_amount")).alias("total_fare"))
    )
    ranked = top_per_key(per_driver, ["city", "trip_date"], ["total_fare"], n, then=["driver_id"])
    return ranked.withColumn("total_fare", money_out("total_fare"))


def affected_sessions(events: DataFrame, boundary) -> DataFrame:
    """Sessions that an event newer than ``boundary`` is or ever was in."""
    touched = newer_than(events, boundary).select("event_id").distinct()
    return events.join(touched, "event_id", "left_semi").select("session_id").distinct()


def session_metrics(events: DataFrame, products: DataFrame, boundary=None, sessions: DataFrame | None = None) -> DataFrame:
    """Metrics per session of the newest delivery of each event.

    With a ``boundary``, the sessions that anything newer touches, each from all
    of its events, ready to replace what was published of them; ``sessions``
    gives them where they are known already.

    ``total_value`` sums the product price over all events of the session, views
    included. Products that are not active count without price and category.
    """
    deliveries = events.select(
        "event_id", "ingestion_time", "session_id", "user_id", "event_time", "event_type", "product_id"
    )
    if sessions is None and boundary is not None:
        sessions = written(affected_sessions(events, boundary), "affected-sessions")
    if sessions is not None:
        members = rows_of(deliveries, sessions, ["session_id"]).select("event_id").distinct()
        deliveries = deliveries.join(members, "event_id", "left_semi")
    newest = latest_per_key(deliveries, ["event_id"], ["ingestion_time", "event_time", "event_type"])
    if sessions is not None:
        newest = rows_of(newest, sessions, ["session_id"])
    active = products.filter("is_active").select("product_id", "category", money("price").alias("price"))
    return (
        dimension_join(newest, active, ["product_id"], "left")
        .groupBy("session_id", "user_id")
        .agg(
            F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"),
            F.count(F.lit(1)).alias("total_events"),
            count_where(F.col("event_type") == "click").alias("total_clicks"),
            money_out(F.sum("price")).alias("total_value"),
            F.countDistinct("category").alias("category_diversity"),
        )
        .withColumn("event_date", F.to_date("session_start"))
    )


def paid_orders(
    orders: DataFrame, payments: DataFrame, refunds: DataFrame, rates: DataFrame, last_payment_only: bool = False,
    dates: DataFrame | None = None,
) -> DataFrame:
    """One row per successfully paid order, with refunds and amounts in the reporting currency.

    ``dates(order_date)`` limits the result to orders whose newest version is on one of them.

    Refunds are deduplicated like the other inputs, so a replay does not double
    them. A currency without rate keeps its order, with null amounts.

    ``last_payment_only`` keeps only the last payment of an order before the
    status is looked at; the default sums all successful payments, so a failed
    retry does not hide a success.
    """
    newest_orders = latest_per_key(orders, ["order_id"], ["ingestion_time", "amount"]).withColumn(
        "order_date", F.to_date("order_time")
    )
    if dates is not None:
        newest_orders = rows_of(newest_orders, dates, ["order_date"])
    if last_payment_only:
        last = latest_per_key(payments, ["order_id"], ["ingestion_time", "payment_id"])
        paid = last.filter(F.col("payment_status") == "SUCCESS").select("order_id", "paid_amount")
    else:
        newest = latest_per_key(payments, ["payment_id"], ["ingestion_time", "payment_status"])
        succeeded = newest.filter(F.col("payment_status") == "SUCCESS")
        paid = sum_before_join(succeeded, ["order_id"], paid_amount="paid_amount")
    newest_refunds = latest_per_key(refunds, ["refund_id"], ["ingestion_time", "seq", "refund_amount"])
    refunded = sum_before_join(newest_refunds, ["order_id"], total_refund="refund_amount")
    full = newest_orders.join(paid, "order_id").join(refunded, "order_id", "left").fillna(0, ["total_refund"])
    return dimension_join(full, rates, ["currency"], "left").select(
        "order_id", "order_date", "currency", "amount", "paid_amount",
        (F.col("amount") * F.col("fx_rate")).alias("amount_base"),
        (F.col("total_refund").cast("decimal(18,2)") * F.col("fx_rate")).alias("refund_base"),
    )


def revenue_by_day(paid: DataFrame) -> DataFrame:
    """Daily revenue of ``paid_orders``: orders, gross, refunds, net and payment mismatches.

    ``paid_orders`` has one row per order, so counting rows counts orders and
    saves the second shuffle of a distinct count.
    """
    return (
        paid.groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("amount_base").alias("gross"), F.sum("refund_base").alias("refunded"),
            count_where(differs(F.col("paid_amount"), F.col("amount"), MISMATCH_TOLERANCE)).alias("mismatch_count"),
        )
        .select(
            "order_date", "total_orders", money_out("gross").alias("gross_revenue"),
            money_out("refunded").alias("refund_amount"),
            money_out(money_total("gross") - money_total("refunded")).alias("net_revenue"), "mismatch_count",
        )
    )


def daily_revenue(orders, payments, refunds, rates, last_payment_only: bool = False) -> DataFrame:
    return revenue_by_day(paid_orders(orders, payments, refunds, rates, last_payment_only))


def unrated_orders(orders: DataFrame, rates: DataFrame) -> DataFrame:
    """Orders per currency that has no rate; look at it before publishing revenue."""
    newest = latest_per_key(orders, ["order_id"], ["ingestion_time", "amount"])
    return newest.join(rates, "currency", "left_anti").groupBy("currency").agg(
        F.count(F.lit(1)).alias("order_count")
    )


def affected_dates(orders: DataFrame, payments: DataFrame, refunds: DataFrame, boundary) -> DataFrame:
    """Order dates that anything newer than ``boundary`` touches.

    An old order that is paid or refunded today counts, and so does every date
    that a corrected order ever had.
    """
    touched = (
        newer_than(orders, boundary).select("order_id")
        .unionByName(newer_than(payments, boundary).select("order_id"))
        .unionByName(newer_than(refunds, boundary).select("order_id"))
    )
    dated = orders.select("order_id", F.to_date("order_time").alias("order_date"))
    return dated.join(touched.distinct(), "order_id", "left_semi").select("order_date").distinct()


def daily_revenue_since(orders, payments, refunds, rates, boundary) -> DataFrame:
    """Daily revenue of the affected dates only, each recomputed from all of its orders.

    Ready for ``sinks.layout.replace_partitions``: other dates stay as they are.
    The dates, one row per calendar day, are written once and then read as a
    small table of known size.
    """
    dates = written(affected_dates(orders, payments, refunds, boundary), "affected-dates")
    return _revenue_on(dates, orders, payments, refunds, rates)


def _revenue_on(dates: DataFrame, orders, payments, refunds, rates) -> DataFrame:
    """Daily revenue of ``dates`` only. All inputs are cut to the orders that ever fell on them before any dedup."""
    dated = orders.withColumn("order_date", F.to_date("order_time"))
    ids = written(rows_of(dated, dates, ["order_date"]).select("order_id").distinct(), "affected-orders")
    own = [frame.join(ids, "order_id", "left_semi") for frame in (orders, payments, refunds)]
    return revenue_by_day(paid_orders(*own, rates, dates=dates))


def _by_month(days: DataFrame) -> DataFrame:
    return days.withColumn(MONTH, (F.year("order_date") * 100 + F.month("order_date")).cast("int"))


def published_daily_revenue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(MONTH)


def publish_daily_revenue(orders, payments, refunds, rates, path: str, boundary=None) -> None:
    """Write daily revenue by month: all of it, or the dates that anything newer than ``boundary`` touches.

    A day is one row, so a partition holds a month of them; a later run reads
    and replaces the months of the dates it recomputes, and no others. Orders
    without a time form a date (and a month) of their own. A date on which no
    order is left goes, and so does a month. Running it again writes the same.
    """
    if boundary is None:
        replace_partitions(_by_month(daily_revenue(orders, payments, refunds, rates)), path, [MONTH])
        return
    spark = orders.sparkSession
    dates = written(_by_month(affected_dates(orders, payments, refunds, boundary)), "affected-dates")
    days = _by_month(_revenue_on(dates, orders, payments, refunds, rates))
    months = [r[0] for r in dates.select(MONTH).distinct().collect()]
    dated = [m for m in months if m is not None]
    touched = F.col(MONTH).isin(dated) | F.col(MONTH).isNull() if None in months else F.col(MONTH).isin(dated)
    stored = rows_of(spark.read.parquet(path).filter(touched), dates, ["order_date"], "left_anti")
    replace_within(spark, stored.select(*days.columns).unionByName(days), path, MONTH, dates)


def rolling_features(transactions: DataFrame, users: DataFrame, by_rows: bool = False) -> DataFrame:
    """Daily and 30-day amount and count per known user.

    Totals per day are formed first: both the user join and the window then see
    one row per user and day. ``by_rows`` counts stored days, not calendar days.
    """
    daily = daily_totals(
        transactions, ["user_id"], "event_time", "event_date",
        daily_amount=F.sum(money("amount")), daily_count=F.count(F.lit(1)),
    )
    known = dimension_join(daily, users.select("user_id"), ["user_id"], "left_semi")
    roll = rolling_rows if by_rows else rolling_days
    rolled = roll(
        known, ["user_id"], "event_date", FEATURE_DAYS,
        {"total_amount_30d": "daily_amount", "transaction_count_30d": "daily_count"},
    )
    return rolled.withColumns({c: money_out(c) for c in ("daily_amount", "total_amount_30d")})
