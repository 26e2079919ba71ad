"""Customer, product, seasonal and monthly metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import SALES, SalesColumns
from tillwise.functions.columns import days_between, mean, month_label, ratio
from tillwise.operators.aggregates import customer_totals, grouped_sales
from tillwise.operators.quantiles import approximate_quantiles, exact_quantiles
from tillwise.staging import stage

# Quartiles, rank error of the approximate mode and segment labels.
QUARTILES = (0.25, 0.5, 0.75)
RANK_ERROR = 0.05
SEGMENTS = ("Low", "Medium", "High", "Very High")


def latest_order_date(totals: DataFrame) -> dt.date | None:
    """Latest order date of the data, from the small per-customer table."""
    return totals.agg(F.max("last_order_date")).first()[0]


def customer_values(
    totals: DataFrame, analysis_date: dt.date | None, cols: SalesColumns = SALES
) -> DataFrame:
    """Lifetime value, recency and frequency from the per-customer totals.

    A customer who first ordered on the analysis date has no tenure and therefore
    a null value.
    """
    day = F.lit(analysis_date).cast("date")
    tenure = days_between(day, F.col("first_order_date"))
    return totals.select(
        cols.customer,
        ratio(F.col("total_revenue"), tenure).alias("ltv"),
        days_between(day, F.col("last_order_date")).alias("recency"),
        F.col("total_orders").alias("frequency"),
        "total_revenue",
    )


def value_cuts(
    values: DataFrame, mode: str = "exact", relative_error: float = RANK_ERROR
) -> list[float]:
    """The three quartiles of ``ltv``; empty when no customer has a value."""
    if mode == "exact":
        return exact_quantiles(values, "ltv", QUARTILES)
    if mode == "approx":
        return approximate_quantiles(values, "ltv", QUARTILES, relative_error)
    raise ValueError(f"unknown quantile mode {mode!r}")


def segment(value: Column, cuts: list[float], null_segment: str = SEGMENTS[3]) -> Column:
    """Label by quartile; a value equal to a cut belongs below it."""
    label = F.when(value.isNull(), null_segment)
    for cut, name in zip(cuts, SEGMENTS):
        label = label.when(value <= cut, name)
    return label.otherwise(SEGMENTS[3])


def customer_metrics(
    sales: DataFrame,
    cols: SalesColumns = SALES,
    *,
    mode: str = "exact",
    relative_error: float = RANK_ERROR,
    analysis_date: dt.date | None = None,
    null_segment: str = SEGMENTS[3],
    revenue: Column | None = None,
    approximate_orders: float | None = None,
) -> DataFrame:
    """One row per customer: value, segment, recency, frequency, revenue.

    The analysis date is the latest order date of the data unless one is given.
    Runs when called: the per-customer totals are written once to the shared
    folder, and date, quartiles and result all read that small table instead of
    aggregating the fact again. Only the date and the three quartiles reach the driver.
    """
    totals = stage(customer_totals(sales, cols, revenue, approximate_orders), "customer-totals")
    values = customer_values(totals, analysis_date or latest_order_date(totals), cols)
    return label_customers(values, value_cuts(values, mode, relative_error), cols, null_segment)


def label_customers(
    values: DataFrame, cuts: list[float], cols: SalesColumns = SALES, null_segment: str = SEGMENTS[3]
) -> DataFrame:
    """The customers' values with the segment that the quartiles ``cuts`` give them."""
    return values.select(
        cols.customer,
        "ltv",
        segment(F.col("ltv"), cuts, null_segment).alias("ltv_segment"),
        "recency",
        "frequency",
        "total_revenue",
    )


def product_metrics(
    sales: DataFrame, cols: SalesColumns = SALES, revenue: Column | None = None
) -> DataFrame:
    """Volume, revenue and mean quantity per line of each product."""
    return sales.groupBy(cols.product).agg(
        F.sum(cols.quantity).alias("sales_volume"),
        F.sum(cols.price if revenue is None else revenue).alias("total_revenue"),
        mean(cols.quantity).alias("average_order_quantity"),
    )


def seasonal_sales_metrics(
    enriched: DataFrame,
    cols: SalesColumns = SALES,
    revenue: Column | None = None,
    approximate_orders: float | None = None,
) -> DataFrame:
    """Sales per weather condition; lines without weather form the null group."""
    return grouped_sales(enriched, cols.condition, cols, revenue, approximate_orders)


def monthly_sales_metrics(
    sales: DataFrame,
    cols: SalesColumns = SALES,
    revenue: Column | None = None,
    approximate_orders: float | None = None,
) -> DataFrame:
    """Sales per month. Grouped on the first day of the month, which is a 4-byte
    key, and labelled afterwards."""
    by_month = grouped_sales(
        sales.withColumn("month_start", F.trunc(cols.date, "month")),
        "month_start",
        cols,
        revenue,
        approximate_orders,
    )
    return by_month.select(
        month_label("month_start").alias("year_month"),
        *[c for c in by_month.columns if c != "month_start"],
    )
