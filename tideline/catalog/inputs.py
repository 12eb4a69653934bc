"""Pipeline inputs, derived by Spark from the given tables.

The given tables have clean rows. Each input keeps every one of them and adds
the disorder its pipeline must cope with: re-deliveries, corrections, failed
payments, late and invalid changes. The remainders below choose *which* rows
are disturbed; none of them drops rows to make an input smaller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import money
from tideline.operators.joins import dimension_join

# Conversion rates of the reporting currency. Currency C4 has
# none on purpose.
RATES = (("C0", "1.00"), ("C1", "1.10"), ("C2", "0.90"), ("C3", "1.25"))
NEXT_BATCH_STARTS = "1999-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _later(time: str, amount: str, unit: str) -> Column:
    return F.expr(f"{time} + {amount} * INTERVAL '1' {unit}")


def _deliveries(again: Column) -> Column:
    """0 for each row, and 1 for its second delivery where ``again`` holds: one scan, no union."""
    return F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def clicks_from(events: DataFrame, days_earlier: Column | None = None) -> DataFrame:
    """Clickstream; every tenth event arrives again, changed, five hours later.

    ``days_earlier`` moves the time of the second delivery back by whole days.
    """
    second = F.col("delivery") == 1
    events = events if days_earlier is None else events.withColumn("earlier", days_earlier)
    return events.withColumn("delivery", _deliveries(F.col("event_id") % 10 == 0)).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.when(second, F.lit("click")).otherwise(F.col("event_type")).alias("event_type"),
        (F.col("ts") if days_earlier is None else F.expr("ts - earlier * delivery * INTERVAL '1' DAY")).alias("event_time"),
        _later("ts", "(event_id % 73 + 5 * delivery)", "HOUR").alias("ingestion_time"),
        F.concat_ws("-", "user_id", F.to_date("ts")).alias("session_id"),
        F.element_at(F.array(F.lit("web"), F.lit("ios"), F.lit("android")), (F.col("event_id") % 3 + 1).cast("int")).alias("device"),
        F.col("value").alias("amount"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_from(table(spark, sf_dir, "events"))


def moving_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream in which every third second delivery dates its event one day earlier, and with it the session."""
    return clicks_from(table(spark, sf_dir, "events"), F.when(F.col("event_id") % 30 == 0, 1).otherwise(0))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"),
        (F.col("p_size") <= 40).alias("is_active"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; every twentieth is corrected five days later."""
    return (
        table(spark, sf_dir, "orders")
        .withColumn("delivery", _deliveries(F.col("o_orderkey") % 20 == 0))
        .select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
            (F.col("o_orderkey") % 200).alias("product_id"),
            (money("o_totalprice") + F.col("delivery") * 10).cast("decimal(18,2)").alias("amount"),
            F.concat(F.lit("C"), F.col("o_custkey") % 5).alias("currency"),
            F.col("o_orderdate").alias("order_time"),
            F.when(F.col("delivery") == 1, _later("o_orderdate", "5", "DAY"))
            .otherwise(_later("o_orderdate", "(o_orderkey % 4)", "DAY")).alias("ingestion_time"),
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, some off by an amount, and second attempts that fail."""
    key, second = F.col("o_orderkey"), F.col("delivery") == 1
    paid = (
        money("o_totalprice")
        + F.when(key % 20 == 0, 10).otherwise(0)
        - F.when(key % 50 == 7, 5).otherwise(0)
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("delivery", _deliveries(key % 30 == 1))
        .select(
            (key * 10 + F.col("delivery")).alias("payment_id"), key.alias("order_id"),
            paid.cast("decimal(18,2)").alias("paid_amount"),
            F.when(second | (F.col("o_orderstatus") == "O"), F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("payment_status"),
            F.col("o_orderdate").alias("payment_time"),
            _later("o_orderdate", "(1 + delivery)", "DAY").alias("ingestion_time"),
        )
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines as partial refunds; repeated line numbers act as replays."""
    return table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("refund_id"),
        F.col("l_orderkey").alias("order_id"),
        money(F.col("l_quantity") * 10).alias("refund_amount"),
        F.col("l_shipdate").alias("refund_time"),
        _later("l_shipdate", "(l_partkey % 4)", "DAY").alias("ingestion_time"),
        F.col("l_partkey").alias("seq"),
    )


def rates(spark: SparkSession) -> DataFrame:
    listed = ", ".join(f"('{currency}', CAST({rate} AS DECIMAL(10,4)))" for currency, rate in RATES)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS r(currency, fx_rate)")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction log with text times; some are unreadable, every fifteenth row is there twice."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("delivery", _deliveries(F.col("event_id") % 15 == 0))
        .select(
            F.col("event_id").cast("string").alias("transaction_id"), F.col("user_id").cast("string").alias("user_id"),
            (money("value") - 50).cast("double").alias("amount"),
            F.when(F.col("event_id") % 2 == 0, F.lit("credit")).otherwise(F.lit("debit")).alias("transaction_type"),
            F.when(F.col("event_id") % 97 == 0, F.lit("bad"))
            .otherwise(F.concat(F.to_date("ts").cast("string"), F.lit(" 12:00:00"))).alias("transaction_timestamp"),
        )
    )


def with_region(df: DataFrame, spark: SparkSession, sf_dir: str, nation: str) -> DataFrame:
    """Add the region of column ``nation``. Each table is size-checked by itself, before any join."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(nation), "n_regionkey")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return dimension_join(dimension_join(df, nations, [nation]), regions, ["n_regionkey"])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips of a supplier; repeated line numbers act as duplicates."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    lines = dimension_join(table(spark, sf_dir, "lineitem"), suppliers, ["l_suppkey"])
    return with_region(lines, spark, sf_dir, "s_nationkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"), F.col("l_suppkey").alias("driver_id"),
        F.col("region").alias("city"), F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_quantity").alias("trip_distance"), F.col("l_shipdate").alias("trip_timestamp"),
        F.col("l_partkey").alias("seq"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("risk_score"),
        F.col("c_mktsegment").alias("user_segment"),
    )


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change per order: the order status moves the customer's risk level."""
    status = F.col("o_orderstatus")
    risk = F.when(status == "F", "LOW").when(status == "O", "MEDIUM").when(status == "P", "HIGH")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    joined = dimension_join(table(spark, sf_dir, "orders"), customers, ["o_custkey"])
    return joined.select(
        F.col("o_custkey").alias("customer_id"), F.col("c_name").alias("name"),
        F.concat(F.lit("e"), F.col("o_custkey"), F.lit("@x.org")).alias("email"),
        F.col("c_mktsegment").alias("address"), risk.alias("risk_level"),
        F.col("o_orderdate").alias("updated_at"),
        _later("o_orderdate", "(o_orderkey % 5)", "DAY").alias("ingestion_time"),
        F.col("o_orderkey").alias("seq"),
    )


def is_first_load(updates: DataFrame) -> DataFrame:
    """Changes of the first load that arrived in time."""
    return updates.filter((F.col("updated_at") < F.lit(NEXT_BATCH_STARTS).cast("timestamp_ntz")) & (F.col("seq") % 7 != 0))


def is_on_time(updates: DataFrame) -> DataFrame:
    """All changes but the late deliveries."""
    return updates.filter(F.col("seq") % 7 != 0)


def is_behind(updates: DataFrame) -> DataFrame:
    """The late deliveries of all times."""
    return updates.filter(F.col("seq") % 7 == 0)


def is_next_batch(updates: DataFrame) -> DataFrame:
    """All changes that the first load has not seen, the late ones among them."""
    return updates.filter((F.col("updated_at") >= F.lit(NEXT_BATCH_STARTS).cast("timestamp_ntz")) | (F.col("seq") % 7 == 0))


def product_versions(spark: SparkSession, sf_dir: str, raised: bool) -> DataFrame:
    """Product rows: the first load, or the update that raises two prices in three."""
    rise = F.col("p_partkey") % 3 if raised else F.lit(0)
    at = "2024-02-01 00:00:00" if raised else "2024-01-01 00:00:00"
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), (money("p_retailprice") + rise).cast("double").alias("price"),
        F.lit("active").alias("status"), F.lit(at).cast("timestamp_ntz").alias("updated_at"),
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change event per order; every fortieth has an operation nobody knows."""
    status = F.col("o_orderstatus")
    operation = (
        F.when(F.col("o_orderkey") % 40 == 0, "NOOP")
        .when(status == "O", "INSERT").when(status == "P", "UPDATE").when(status == "F", "DELETE")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("CITY"), F.col("o_orderkey") % 25).alias("city"),
        operation.alias("operation"), F.col("o_orderdate").alias("event_time"), F.col("o_orderkey").alias("seq"),
    )


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as raw sales; the first line of an order has no price."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").cast("int").alias("units_sold"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def skewed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which one user has nine in ten."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 100 < 90, F.lit(0)).otherwise(F.col("user_id")).cast("bigint").alias("user_id"),
        F.col("ts").alias("event_time"), "event_type", F.col("value").alias("amount"),
    )
