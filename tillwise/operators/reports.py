"""The five reports over the metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_sales_per_customer(customer_metrics: DataFrame) -> DataFrame:
    return customer_metrics.select(
        "customer_id", F.col("total_revenue").alias("total_sales_amount")
    )


def average_quantity_per_product(product_metrics: DataFrame) -> DataFrame:
    return product_metrics.select("product_id", "average_order_quantity")


def top_products(product_metrics: DataFrame, n: int = 5) -> DataFrame:
    """The n products sold most; equal volumes are ordered by product."""
    return (
        product_metrics.select("product_id", "sales_volume")
        .orderBy(F.desc("sales_volume"), F.asc("product_id"))
        .limit(n)
    )


def monthly_trend(monthly_metrics: DataFrame) -> DataFrame:
    return monthly_metrics.select(
        "year_month", "average_sales_volume", "total_sales_volume", "total_sales_revenue"
    ).orderBy("year_month")


def weather_ranking(seasonal_metrics: DataFrame) -> DataFrame:
    """Conditions by volume; equal volumes are ordered by condition."""
    return seasonal_metrics.select(
        "weather_condition", "total_sales_volume", "total_sales_revenue", "average_sales_volume"
    ).orderBy(F.desc("total_sales_volume"), F.asc("weather_condition"))
