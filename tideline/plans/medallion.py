"""Raw sales to a clean layer and a product table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import money, money_out
from tideline.operators.dedup import latest_per_key
from tideline.operators.merge import upsert
from tideline.sinks import snapshots
from tideline.sinks.layout import overwrite

NEWEST_FIRST = ("seq", "price", "units_sold")


def clean_sales(bronze: DataFrame) -> DataFrame:
    """Sales with a price, and their revenue."""
    return bronze.filter(F.col("price").isNotNull()).withColumn(
        "revenue", money_out(money("price") * F.col("units_sold"))
    )


def latest_sale(silver: DataFrame) -> DataFrame:
    """One row per product, as a merge needs."""
    return latest_per_key(silver, ["product_id"], NEWEST_FIRST)


def merged_products(products: DataFrame, silver: DataFrame) -> DataFrame:
    return upsert(products, latest_sale(silver), ["product_id"], unique=True)


def run(spark: SparkSession, bronze: DataFrame, silver_path: str, gold_root: str) -> int:
    """Write the clean layer, then load or merge the product table from it."""
    overwrite(clean_sales(bronze), silver_path)
    silver = spark.read.parquet(silver_path)
    if not snapshots.exists(spark, gold_root):
        return snapshots.publish(latest_sale(silver), gold_root)
    return snapshots.publish(merged_products(snapshots.read(spark, gold_root), silver), gold_root)
