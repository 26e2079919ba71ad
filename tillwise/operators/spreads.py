"""Quantiles from sketches that are kept with the totals and merged.

A sketch of a month's prices takes a few kilobytes however many lines there are. Sketches of
several batches, or of several months, merge into the sketch of all their lines, so quantiles
of any period need no scan of lines. Ranks are off by a share that the size decides, see
:data:`SKETCH_SIZE`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that a sketch keeps at its widest; ranks are then off by less than 1 % of the lines.
SKETCH_SIZE = 400


def sketch(value: Column | str, size: int = SKETCH_SIZE) -> Column:
    """Aggregate: the sketch of a column's values. Nulls and NaN are left out."""
    value = F.col(value).cast("double") if isinstance(value, str) else value.cast("double")
    return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), size)


def merged_sketch(column: str) -> Column:
    """Aggregate: one sketch of everything that the sketches have seen."""
    return F.kll_merge_agg_double(column)


def sketched_values(column: Column | str) -> Column:
    """How many values a sketch has seen."""
    return F.kll_sketch_get_n_double(column)


def sketch_quantile(column: Column | str, probability: float) -> Column:
    """The value at a rank; null of a sketch that has seen none."""
    return F.when(sketched_values(column) > 0, F.kll_sketch_get_quantile_double(column, F.lit(float(probability))))


def price_spreads(lines: DataFrame, month: str = "year_month", price: str = "price") -> DataFrame:
    """(year_month, price_sketch) of the lines; reduced on the map side, a hot month is one sketch per task."""
    return lines.groupBy(F.col(month).alias("year_month")).agg(sketch(price).alias("price_sketch"))


def price_quantiles(
    spreads: DataFrame,
    probabilities: Sequence[float],
    since: str | None = None,
    until: str | None = None,
    *,
    whole_period: bool = False,
) -> DataFrame:
    """(year_month, probability, price, counted) of kept sketches, for the months from ``since`` to ``until``.

    A month may have several sketches, one per batch. ``whole_period`` gives one line per
    probability over all these months, without a month's name. Months without a price have null prices.
    """
    month = F.col("year_month")
    chosen = spreads
    if since is not None:
        chosen = chosen.where(month >= since)
    if until is not None:
        chosen = chosen.where(month <= until)
    keys = [] if whole_period else ["year_month"]
    merged = chosen.groupBy(*keys).agg(merged_sketch("price_sketch").alias("s"))
    lines = [
        F.struct(F.lit(float(p)).alias("probability"), sketch_quantile("s", p).alias("price")) for p in probabilities
    ]
    return merged.select(*keys, F.inline(F.array(*lines)), "s").select(
        *keys, "probability", "price", sketched_values("s").alias("counted")
    )
