"""Quantiles of a column, exact without gathering the column in one task.

An exact quantile is the value at a known rank. The values are counted per slot
of a logarithmic scale, and the slot that holds the rank is found from the running
count. While that slot holds many different values its range is cut into equal
steps and counted again; the few values left are then counted one by one. A small
input, by its checked size, is counted value by value at once.

Only counts per slot meet in one task, and the slot width, not the number of rows,
decides how many there are. Equal values are counted, never listed, so ties cost
nothing. The driver receives at most one line per probability and round.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.staging import fits

SLOTS_PER_OCTAVE = 256
LINEAR_SLOTS = 65536
#: Rows of a bracket that may be counted value by value.
COUNTED_ONE_BY_ONE = 200_000
#: Input that is counted value by value at once; the counts then meet in one task.
COUNTED_AT_ONCE = 4 * 1024 * 1024
# log2 of a double lies between -1075 and 1024
_OCTAVES = 1100


@dataclass(frozen=True)
class _Bracket:
    """The range of values that holds the wanted rank, counted from its low end."""

    low: float
    high: float
    rank: int
    rows: int

    @property
    def solved(self) -> bool:
        return self.low == self.high


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """The smallest values that reach each probability, as ``percentile_disc`` gives them.

    Nulls and NaN are left out; without values the list is empty. ``df`` is scanned
    up to three times or so, and should be a table or a staged frame.
    """
    v = F.col(column).cast("double")
    values = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    found = _first_brackets(values, probabilities)
    while any(not b.solved and b.rows > COUNTED_ONE_BY_ONE for b in found):
        narrower = _narrow(values, found, _linear_slot)
        if narrower == found:
            raise RuntimeError(f"no narrower range found in {found}")
        found = narrower
    if any(not b.solved for b in found):
        found = _narrow(values, found, lambda value, low, high: value)
    return [b.low for b in found]


def approximate_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float
) -> list[float]:
    """Quantiles whose rank is off by at most the given share of rows."""
    return df.approxQuantile(column, list(probabilities), relative_error)


def _log_slot(value: Column) -> Column:
    """Slot number that never falls when the value rises, for either sign."""
    octave = F.least(F.log2(F.abs(value)), F.lit(1024.0))
    # infinity has a slot of its own: no step divides a range that ends in it
    endless = (F.abs(value) == float("inf")).cast("int")
    size = F.floor(octave * SLOTS_PER_OCTAVE) + _OCTAVES * SLOTS_PER_OCTAVE + endless
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0)


def _linear_slot(value: Column, low: Column, high: Column) -> Column:
    """Step of the value between the ends; the two ends never share a step."""
    return F.when(high > low, F.floor((value - low) / (high - low) * LINEAR_SLOTS)).otherwise(0)


def _running_counts(values: DataFrame, part: Column, slot: Column) -> DataFrame:
    """Rows, lowest and highest value per slot, and the rows below it in its part."""
    counts = values.groupBy(part.alias("part"), slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    within = Window.partitionBy("part")
    return counts.select(
        "part", "n", "low", "high",
        (F.sum("n").over(within.orderBy("slot")) - F.col("n")).alias("below"),
        F.sum("n").over(within).alias("total"),
    )


def _holds(rank: Column) -> Column:
    return (rank > F.col("below")) & (rank <= F.col("below") + F.col("n"))


def _first_brackets(values: DataFrame, probabilities: Sequence[float]) -> list[_Bracket]:
    v = F.col("v")
    slot = v if fits(values, COUNTED_AT_ONCE) else _log_slot(v)
    counts = _running_counts(values, F.lit(0), slot)
    found = []
    ranks = [
        F.greatest(F.ceil(F.lit(Decimal(str(p))) * F.col("total")).cast("bigint"), F.lit(1))
        for p in probabilities
    ]
    lines = (
        counts.select("*", *[r.alias(f"rank_{i}") for i, r in enumerate(ranks)])
        .where(reduce(lambda a, b: a | b, [_holds(r) for r in ranks]))
        .collect()  # one slot per probability
    )
    for i in range(len(probabilities)):
        for line in lines:
            inner = line[f"rank_{i}"] - line["below"]
            if 0 < inner <= line["n"]:
                found.append(_Bracket(line["low"], line["high"], inner, line["n"]))
    return found


def _narrow(values: DataFrame, brackets: list[_Bracket], slot) -> list[_Bracket]:
    """Cut every open bracket once more. Brackets of one round are equal or disjoint."""
    v = F.col("v")
    open_ranges = sorted({(b.low, b.high) for b in brackets if not b.solved})

    def pick(end: int) -> Column:
        cases = [F.when(v.between(*r), F.lit(r[end])) for r in open_ranges]
        return F.coalesce(*cases)

    inside = values.where(reduce(lambda a, b: a | b, [v.between(*r) for r in open_ranges]))
    counts = _running_counts(inside, pick(0), slot(v, pick(0), pick(1)))
    wanted = [
        (F.col("part") == b.low) & _holds(F.lit(b.rank)) for b in brackets if not b.solved
    ]
    lines = counts.where(reduce(lambda a, b: a | b, wanted)).collect()  # one slot per probability
    return [b if b.solved else _inner(b, lines) for b in brackets]


def _inner(bracket: _Bracket, lines) -> _Bracket:
    for line in lines:
        inner = bracket.rank - line["below"]
        if line["part"] == bracket.low and 0 < inner <= line["n"]:
            return _Bracket(line["low"], line["high"], inner, line["n"])
    raise RuntimeError("the input changed between two scans")
