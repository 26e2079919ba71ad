"""Group-by building blocks.

Every aggregate here combines on the map side first. ``count_distinct`` makes
Spark shuffle on (group, counted value) before it shuffles on the group alone,
so a group that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import SALES, SalesColumns
from tillwise.functions.columns import mean


def order_count(cols: SalesColumns, approximate: float | None) -> Column:
    """Distinct orders, exact or within the given relative standard deviation."""
    if approximate is None:
        return F.count_distinct(cols.order)
    return F.approx_count_distinct(cols.order, approximate)


def customer_totals(
    sales: DataFrame,
    cols: SalesColumns = SALES,
    revenue: Column | None = None,
    approximate_orders: float | None = None,
) -> DataFrame:
    """One row per customer: revenue, first and last order date, distinct orders."""
    return sales.groupBy(cols.customer).agg(
        F.sum(cols.price if revenue is None else revenue).alias("total_revenue"),
        F.min(cols.date).alias("first_order_date"),
        F.max(cols.date).alias("last_order_date"),
        order_count(cols, approximate_orders).alias("total_orders"),
    )


def grouped_sales(
    sales: DataFrame,
    group: str,
    cols: SalesColumns = SALES,
    revenue: Column | None = None,
    approximate_orders: float | None = None,
) -> DataFrame:
    """Volume, revenue, mean quantity per line and distinct orders per group."""
    return sales.groupBy(group).agg(
        F.sum(cols.quantity).alias("total_sales_volume"),
        F.sum(cols.price if revenue is None else revenue).alias("total_sales_revenue"),
        mean(cols.quantity).alias("average_sales_volume"),
        order_count(cols, approximate_orders).alias("order_count"),
    )


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; keys with a null are exempt."""
    complete = df.select(*key).dropna()
    return (
        complete.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )
