"""Scalar expressions, all JVM-side and safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(column: str) -> Column:
    """Text, timestamp or date to date; unreadable text gives null."""
    return F.col(column).try_cast("date")


def as_float(column: str) -> Column:
    """Text to 32-bit float; unreadable text gives null."""
    return F.col(column).try_cast("float")


def as_key(column: str) -> Column:
    """Id of any type to bigint, so that both sides of a join share one type."""
    return F.col(column).try_cast("bigint")


def month_label(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; null where the divisor is zero or null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean(column: str) -> Column:
    """Average over the non-null values, as exact sum over count."""
    return ratio(F.sum(column), F.count(column))


def epoch_seconds(column: str) -> Column:
    """Seconds since 1970 at midnight UTC of a date, whatever the session zone."""
    return F.unix_date(column).cast("bigint") * F.lit(86400)
