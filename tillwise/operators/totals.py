"""Totals that add up: the state from which the metrics are kept current without reading old lines.

Sums, counts, first and last dates and sketches of new lines are simply added to what is held. Distinct
orders do not add up, so the distinct (order, customer, month, condition) rows are held as well: a
group counts an order when it meets it for the first time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import (
    CUSTOMER_TOTALS,
    MONTHLY_TOTALS,
    ORDER_HEADS,
    PRICE_SPREADS,
    PRODUCT_TOTALS,
    SEASONAL_TOTALS,
    Contract,
)
from tillwise.functions.columns import month_label, ratio
from tillwise.operators.conform import conform
from tillwise.operators.metrics import customer_values, label_customers, latest_order_date, value_cuts
from tillwise.operators.spreads import merged_sketch, price_spreads
from tillwise.staging import fits_broadcast

ALL = (CUSTOMER_TOTALS, PRODUCT_TOTALS, SEASONAL_TOTALS, MONTHLY_TOTALS, PRICE_SPREADS)

#: Columns that add up by another function than the sum.
_MERGE = {"first_order_date": F.min, "last_order_date": F.max, "price_sketch": merged_sketch}


def measured_lines(sales: DataFrame, no_weather: str) -> DataFrame:
    """Lines of the sales table with their month; those without weather are ``no_weather``."""
    return sales.select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "price",
        "order_date",
        month_label("order_date").alias("year_month"),
        F.coalesce("weather_condition", F.lit(no_weather)).alias("weather_condition"),
    )


def order_heads(lines: DataFrame) -> DataFrame:
    """The distinct heads of the lines' orders."""
    return lines.select(*ORDER_HEADS.names).distinct()


def heads_again(held: DataFrame, heads: DataFrame) -> DataFrame:
    """The held heads of orders that ``heads`` has, too."""
    orders = heads.select("order_id").distinct()
    return held.join(F.broadcast(orders) if fits_broadcast(orders) else orders, "order_id", "left_semi")


def additions(contract: Contract, lines: DataFrame, heads: DataFrame, known: DataFrame) -> DataFrame:
    """Rows to add to the totals for new ``lines`` with the heads ``heads``; a group may have two.

    ``known`` are the held heads of the same orders: a pair of group and order that is among them
    was counted before.
    """
    if contract is PRICE_SPREADS:
        return conform(price_spreads(lines), contract)
    if contract is PRODUCT_TOTALS:
        return conform(
            lines.groupBy("product_id").agg(
                F.sum("quantity").alias("sales_volume"),
                F.sum("price").alias("total_revenue"),
                F.count("quantity").alias("counted"),
            ),
            contract,
        )
    key = contract.names[0]
    if contract is CUSTOMER_TOTALS:
        sums = [
            F.sum("price").alias("total_revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        ]
    else:
        sums = [
            F.sum("quantity").alias("total_sales_volume"),
            F.sum("price").alias("total_sales_revenue"),
            F.count("quantity").alias("counted"),
        ]
    orders = contract.names[-1]
    added = lines.groupBy(key).agg(*sums)
    pairs = heads.select(key, "order_id").distinct().join(known.select(key, "order_id").distinct(), [key, "order_id"], "left_anti")
    counts = pairs.groupBy(key).agg(F.count(F.lit(1)).alias(orders))
    return conform(added.unionByName(counts, allowMissingColumns=True), contract)


def merged(contract: Contract) -> Callable[[DataFrame], DataFrame]:
    """The function that adds up the rows of the totals, one row per group."""
    key = contract.names[0]

    def merge(rows: DataFrame) -> DataFrame:
        sums = [_MERGE.get(c.name, F.sum)(c.name).cast(c.type).alias(c.name) for c in contract.columns[1:]]
        return rows.groupBy(key).agg(*sums)

    return merge


# ----------------------------------------------------------------- metrics of totals


def customer_metrics_of(totals: DataFrame, mode: str = "exact", analysis_date: dt.date | None = None) -> DataFrame:
    """The customer metrics of merged totals; a table or a staged frame, since it is read several times."""
    values = customer_values(totals, analysis_date or latest_order_date(totals))
    return label_customers(values, value_cuts(values, mode))


def product_metrics_of(totals: DataFrame) -> DataFrame:
    return totals.select(
        "product_id", "sales_volume", "total_revenue", ratio(F.col("sales_volume"), F.col("counted")).alias("average_order_quantity")
    )


def grouped_metrics_of(totals: DataFrame) -> DataFrame:
    """Monthly or seasonal metrics."""
    average = ratio(F.col("total_sales_volume"), F.col("counted")).alias("average_sales_volume")
    return totals.select(totals.columns[0], "total_sales_volume", "total_sales_revenue", average, "order_count")
