from decimal import Decimal

from pyspark.sql import functions as F

from support import at, plan, rows
from tideline.catalog import inputs
from tideline.operators.rolling import rolling_days, rolling_rows
from tideline.plans import marts
from tideline.sources.incremental import newer_than


def order(spark, *data):
    return spark.createDataFrame(
        [(o, Decimal(a), c, at(t), at(i)) for o, a, c, t, i in data],
        "order_id int, amount decimal(18,2), currency string, order_time timestamp_ntz, ingestion_time timestamp_ntz",
    )


def payment(spark, *data):
    return spark.createDataFrame(
        [(p, o, Decimal(a), s, at(i)) for p, o, a, s, i in data],
        "payment_id int, order_id int, paid_amount decimal(18,2), payment_status string, ingestion_time timestamp_ntz",
    )


def refund(spark, *data):
    return spark.createDataFrame(
        [(r, o, Decimal(a), at(i), n) for n, (r, o, a, i) in enumerate(data)],
        "refund_id int, order_id int, refund_amount decimal(18,2), ingestion_time timestamp_ntz, seq int",
    )


def world(spark):
    return (
        order(spark, (1, "100", "C1", "2024-01-01", "2024-01-01"), (1, "110", "C1", "2024-01-01", "2024-01-03"),
              (2, "50", "C9", "2024-01-01", "2024-01-01"), (3, "10", "C0", "2024-01-02", "2024-01-02"),
              (4, "70", "C0", "2024-01-05", "2024-01-05")),
        payment(spark, (10, 1, "60", "SUCCESS", "2024-01-01"), (11, 1, "50", "SUCCESS", "2024-01-02"),
                (12, 1, "110", "FAILED", "2024-01-03"), (20, 2, "50", "SUCCESS", "2024-01-01"),
                (30, 3, "9", "SUCCESS", "2024-01-09"), (40, 4, "70", "FAILED", "2024-01-05")),
        refund(spark, (1, 1, "20", "2024-01-02"), (1, 1, "20", "2024-01-04"), (2, 1, "5", "2024-01-04")),
        inputs.rates(spark),
    )


def test_revenue(spark):
    """Parts of a payment add up, a failed retry hides nothing, replayed refunds count once."""
    day = {str(r["order_date"]): r for r in marts.daily_revenue(*world(spark)).collect()}
    first = day["2024-01-01"]
    assert (first["total_orders"], first["gross_revenue"], first["refund_amount"], first["net_revenue"]) == (2, 121.0, 27.5, 93.5)
    assert first["mismatch_count"] == 0 and day["2024-01-02"]["mismatch_count"] == 1
    assert set(day) == {"2024-01-01", "2024-01-02"}


def test_revenue_with_last_payment_only(spark):
    day = {str(r["order_date"]): r for r in marts.daily_revenue(*world(spark), last_payment_only=True).collect()}
    assert day["2024-01-01"]["total_orders"] == 1


def test_currency_without_rate_is_reported(spark):
    orders, _, _, rates = world(spark)
    assert rows(marts.unrated_orders(orders, rates)) == [("C9", 1)]


def test_late_payment_recomputes_its_whole_date(spark):
    orders, payments, refunds, rates = world(spark)
    since = marts.daily_revenue_since(orders, payments, refunds, rates, "2024-01-08")
    full = marts.daily_revenue(orders, payments, refunds, rates)
    assert rows(since) == rows(full.filter("order_date = '2024-01-02'"))


def test_moved_order_touches_both_dates(spark):
    _, payments, refunds, rates = world(spark)
    orders = order(spark, (1, "100", "C0", "2024-01-01", "2024-01-01"), (1, "100", "C0", "2024-01-04", "2024-01-09"))
    dates = marts.affected_dates(orders, payments.limit(0), refunds.limit(0), "2024-01-08")
    assert [str(r[0]) for r in rows(dates)] == ["2024-01-01", "2024-01-04"]


def test_revenue_is_the_same_for_any_partitioning(spark, tables):
    one = [inputs.orders(spark, tables), inputs.payments(spark, tables), inputs.refunds(spark, tables)]
    want = rows(marts.daily_revenue(*one, inputs.rates(spark)))
    assert rows(marts.daily_revenue(*[df.repartition(5) for df in one], inputs.rates(spark))) == want


def test_rolling_over_days_and_rows_differ_at_gaps(spark):
    daily = spark.createDataFrame(
        [("u", at(d).date(), n) for d, n in [("2024-01-01", 1), ("2024-01-02", 2), ("2024-03-01", 4)]],
        "user_id string, day date, n int",
    )
    days = rolling_days(daily, ["user_id"], "day", 30, {"s": "n"})
    by_rows = rolling_rows(daily, ["user_id"], "day", 30, {"s": "n"})
    assert [r[0] for r in rows(days, "s")] == [1, 3, 4] and [r[0] for r in rows(by_rows, "s")] == [1, 3, 7]


def test_sessions_keep_the_newest_delivery_and_inactive_products(spark):
    events = spark.createDataFrame(
        [("e1", "s", "u", 1, "view", at("2024-01-01 10:00"), at("2024-01-01 10:00")),
         ("e1", "s", "u", 1, "click", at("2024-01-01 10:00"), at("2024-01-01 15:00")),
         ("e2", "s", "u", 2, "view", at("2024-01-01 11:00"), at("2024-01-01 11:00"))],
        "event_id string, session_id string, user_id string, product_id int, event_type string, "
        "event_time timestamp_ntz, ingestion_time timestamp_ntz",
    )
    products = spark.sql("SELECT * FROM VALUES (1, 'toys', 2.5D, true), (2, 'food', 9.0D, false) AS p(product_id, category, price, is_active)")
    row = marts.session_metrics(events, products).first()
    assert (row["total_events"], row["total_clicks"], row["total_value"], row["category_diversity"]) == (2, 1, 2.5, 1)


def test_filters_and_columns_reach_the_scan(spark, tables):
    events = spark.read.parquet(f"{tables}/events.parquet").withColumnRenamed("ts", "ingestion_time")
    text = plan(newer_than(events, "2024-01-15").select("event_id"))
    assert "GreaterThan(ts" in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_plans_have_no_python_and_no_cartesian_product(spark, tables):
    from tideline.catalog.queries import registered

    for name in ("regional_sales", "daily_revenue", "daily_revenue_since", "session_metrics", "top3_drivers",
                 "rolling_30d", "scd2_history", "heavy_key_join", "top_key_share"):
        text = plan(registered()[name](spark, tables))
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text, name


def test_regional_sales_ignores_unknown_products(spark):
    lines = spark.sql("SELECT * FROM VALUES (1, 1, 5.0D), (1, 9, 7.0D), (2, 1, 1.5D) AS l(customer_id, product_id, amount)")
    customers = spark.sql("SELECT * FROM VALUES (1, 'EU'), (2, 'EU') AS c(customer_id, region)")
    products = spark.sql("SELECT 1 AS product_id")
    assert rows(marts.regional_sales(lines, customers, products)) == [("EU", 6.5)]
    assert lines.select(F.count("*")).first()[0] == 3


def test_a_date_without_orders_left_loses_its_partition(spark, tmp_path):
    """The only order of 1 January moves to the 2nd; the incremental run equals a full one."""
    order = "order_id int, user_id int, product_id int, amount decimal(18,2), currency string, order_time timestamp_ntz, ingestion_time timestamp_ntz"
    orders = spark.createDataFrame([(1, 1, 1, Decimal(5), "C0", at("2024-01-01"), at("2024-01-01")), (2, 1, 1, Decimal(7), "C0", at("2024-01-02"), at("2024-01-02"))], order)
    moved = orders.union(spark.createDataFrame([(1, 1, 1, Decimal(5), "C0", at("2024-01-02"), at("2024-01-05"))], order))
    payments = spark.createDataFrame(
        [(i, i, Decimal(5), "SUCCESS", at("2024-01-02"), at("2024-01-02")) for i in (1, 2)],
        "payment_id int, order_id int, paid_amount decimal(18,2), payment_status string, payment_time timestamp_ntz, ingestion_time timestamp_ntz",
    )
    refunds = spark.createDataFrame([], "refund_id int, order_id int, refund_amount decimal(18,2), refund_time timestamp_ntz, ingestion_time timestamp_ntz, seq int")
    rates = spark.sql("SELECT 'C0' AS currency, CAST(1 AS DECIMAL(10,4)) AS fx_rate")
    path = str(tmp_path / "days")
    marts.publish_daily_revenue(orders, payments, refunds, rates, path)
    assert marts.published_daily_revenue(spark, path).count() == 2
    marts.publish_daily_revenue(moved, payments, refunds, rates, path, "2024-01-04 00:00:00")
    shown = lambda df: rows(df, F.col("order_date").cast("string"), "total_orders", "gross_revenue")
    assert shown(marts.published_daily_revenue(spark, path)) == shown(marts.daily_revenue(moved, payments, refunds, rates)) == [("2024-01-02", 2, 12.0)]


def test_an_order_without_time_gets_one_later(spark, tmp_path):
    """A null date is published, refreshed and cleared like any other; untouched months keep their files."""
    _, payments, refunds, rates = world(spark)
    kinds = "order_id int, amount decimal(18,2), currency string, order_time timestamp_ntz, ingestion_time timestamp_ntz"
    paid = spark.createDataFrame([(i * 10, i, Decimal(5), "SUCCESS", at("2024-01-01")) for i in (5, 6, 7)], payments.schema)
    first = [(5, Decimal(5), "C0", None, at("2024-01-01")), (6, Decimal(6), "C0", at("2024-02-02"), at("2024-01-01")), (7, Decimal(7), "C0", at("2024-03-03"), at("2024-01-01"))]
    second = [*first, (5, Decimal(5), "C0", at("2000-05-05"), at("2024-06-01")), (7, Decimal(9), "C0", None, at("2024-06-01"))]
    third = [*second, (7, Decimal(9), "C0", at("2024-03-03"), at("2024-07-01"))]
    path = str(tmp_path / "days")
    publish = lambda given, boundary=None: marts.publish_daily_revenue(
        spark.createDataFrame(given, kinds), paid, refunds, rates, path, boundary)
    publish(first)
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "202402" in f}
    for given, boundary in ((second, "2024-05-01"), (third, "2024-06-15")):
        publish(given, boundary)
        full = marts.daily_revenue(spark.createDataFrame(given, kinds), paid, refunds, rates)
        assert rows(marts.published_daily_revenue(spark, path)) == rows(full)
        assert untouched <= set(spark.read.parquet(path).inputFiles())
    assert not any("HIVE_DEFAULT" in f for f in spark.read.parquet(path).inputFiles())
