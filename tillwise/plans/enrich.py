"""Sales lines with their customer and the weather of their place and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import SALES, SalesColumns
from tillwise.operators.joins import customer_days, with_customers, with_weather
from tillwise.staging import fits_broadcast


def enrich(
    sales: DataFrame, customers: DataFrame, weather: DataFrame, cols: SalesColumns = SALES
) -> DataFrame:
    """Left joins to both; every line stays, once per match.

    While one of the two fits the broadcast limit, the lines are shuffled at most
    once, for the other. When neither fits, joining one after the other would shuffle
    all lines twice, the second time with the customer's texts attached. Instead both
    are joined to the distinct (customer, day) pairs, and the lines are shuffled once,
    on a key that spreads a hot customer over its days.
    """
    direct = fits_broadcast(customers) or fits_broadcast(weather)
    how = enrich_lines if direct else enrich_by_customer_day
    return how(sales, customers, weather, cols)


def enrich_lines(
    sales: DataFrame, customers: DataFrame, weather: DataFrame, cols: SalesColumns = SALES
) -> DataFrame:
    """Join customers, then weather, to every line."""
    return _in_order(with_weather(with_customers(sales, customers, cols), weather, cols), sales, customers, cols)


def enrich_by_customer_day(
    sales: DataFrame, customers: DataFrame, weather: DataFrame, cols: SalesColumns = SALES
) -> DataFrame:
    """Join both to the distinct (customer, day) pairs, then those to the lines."""
    days = with_weather(customer_days(sales, customers, cols), weather, cols).withColumnsRenamed(
        {cols.customer: "_customer", cols.date: "_date"}
    )
    # a line without a date still has its customer, so the date is compared null-safely
    same = (F.col(cols.customer) == F.col("_customer")) & F.col(cols.date).eqNullSafe(F.col("_date"))
    return _in_order(sales.join(days, same, "left"), sales, customers, cols)


def _in_order(
    joined: DataFrame, sales: DataFrame, customers: DataFrame, cols: SalesColumns
) -> DataFrame:
    from_customer = [c for c in customers.columns if c != cols.customer]
    return joined.select(*sales.columns, *from_customer, cols.temperature, cols.condition)
