"""Joins between sales, customers and the weather lookup.

All are plain equi joins: Catalyst broadcasts a side whose estimated size is
under its limit and otherwise sorts and merges, where adaptive execution splits
partitions that one hot key has made large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import SALES, SalesColumns
from tillwise.operators.aggregates import distinct_keys


def with_customers(sales: DataFrame, customers: DataFrame, cols: SalesColumns = SALES) -> DataFrame:
    """Every line, with name, username, email and coordinates where the customer is known."""
    return sales.join(customers, cols.customer, "left")


def with_weather(enriched: DataFrame, weather: DataFrame, cols: SalesColumns = SALES) -> DataFrame:
    """Every line, with the weather of its place and day where there is one.

    Coordinates are 32-bit floats on both sides; a null coordinate matches nothing.
    """
    return enriched.join(weather, cols.place_day, "left")


def customer_days(sales: DataFrame, customers: DataFrame, cols: SalesColumns = SALES) -> DataFrame:
    """Distinct (customer, day) pairs of the fact with the customer's attributes.

    The pairs are reduced on the map side before anything is shuffled, so a
    customer with a third of all lines is one row per day in the join.
    """
    pairs = distinct_keys(sales, cols.customer_day).where(F.col(cols.customer).isNotNull())
    return with_customers(pairs, customers, cols)


def seen_customers(sales: DataFrame, customers: DataFrame, cols: SalesColumns = SALES) -> DataFrame:
    """The customers the lines name, joined to their distinct ids rather than to every line."""
    ids = distinct_keys(sales, [cols.customer])
    return with_customers(ids, customers, cols).distinct()


def place_days(days: DataFrame, cols: SalesColumns = SALES) -> DataFrame:
    """Distinct (latitude, longitude, date) keys of the lookup."""
    return distinct_keys(days, cols.place_day)


def lookup_keys(sales: DataFrame, customers: DataFrame, cols: SalesColumns = SALES) -> DataFrame:
    """Distinct lookup keys of all lines; lines of unknown customers have no place."""
    return place_days(customer_days(sales, customers, cols), cols).dropna()


def orphans(df: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Referenced values without a parent row, with the number of lines that use them.

    Counting per value first keeps a hot value from reaching the join as many rows.
    """
    used = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    known = parents.select(F.col(parent_column).alias(column))
    return used.join(known, column, "left_anti")
