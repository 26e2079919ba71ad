"""Merging a batch into a table by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import CUSTOMERS, SALES_TABLE
from tillwise.operators.aggregates import duplicate_keys
from tillwise.staging import fits_broadcast, only_scans, stage


def first_per_key(batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the other columns.

    The smallest row is an aggregate, so copies of a hot key are reduced on the
    map side and never meet in one task as they would in a window. A value comes
    before a null, so of two copies the more complete one is kept.
    """
    others = [c for c in batch.columns if c not in key]
    ordered = [*order_by, *[c for c in others if c not in order_by]]
    parts = [x for c in ordered for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    smallest = batch.groupBy(*key).agg(F.min(F.struct(*parts)).alias("row"))
    return smallest.select(*key, *[f"row.{c}" for c in ordered]).select(*batch.columns)


def one_per_key(batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`first_per_key` for a batch without nulls in its key.

    Where the batch is large and lies in files, its keys are counted first, which moves them alone.
    The keys that have copies are written aside, and while they fit the broadcast limit only their rows
    are sorted and shuffled; all others stay where they are.
    """
    if fits_broadcast(batch) or not only_scans(batch):
        return first_per_key(batch, key, order_by)
    copied = stage(duplicate_keys(batch, key).select(*key), "copied-keys")
    if not fits_broadcast(copied):
        return first_per_key(batch, key, order_by)
    copied = F.broadcast(copied)
    single = batch.join(copied, list(key), "left_anti").select(*batch.columns)
    return single.unionByName(first_per_key(batch.join(copied, list(key), "left_semi"), key, order_by))


def with_key(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key has no null; the others cannot be merged."""
    return batch.dropna(subset=list(key))


def without_key(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that a merge sets aside, since a part of their key is null."""
    return batch.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key]))


def absent_rows(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target does not hold; reads only the target's key.

    When the batch's keys fit the broadcast limit, the target is first reduced to
    those keys while it is scanned, so that a small batch never shuffles a large
    table. Otherwise both sides are shuffled on the key once.
    """
    held = target.select(*key)
    keys = batch.select(*key)
    if fits_broadcast(keys):
        held = held.join(F.broadcast(keys), list(key), "left_semi")
    return batch.join(held, list(key), "left_anti").select(*batch.columns)


def rows_to_insert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """What ``insert if absent`` adds: existing rows win, one row per key in the batch.

    Rows with a null in the key are left out, see :func:`without_key`.
    """
    return absent_rows(target, first_per_key(with_key(batch, key), key, order_by), key)


def insert_if_absent(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The merged table as a frame. Applying a batch twice changes nothing."""
    return target.unionByName(rows_to_insert(target, batch, key, order_by))


def upsert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The merged table as a frame, where rows of the batch replace existing ones."""
    fresh = first_per_key(with_key(batch, key), key, order_by)
    return absent_rows(fresh, target, key).unionByName(fresh)


def merge_counts(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: batch rows, copies inside the batch, keys already present, rows to insert,
    and rows set aside without a complete key (which are in none of the other counts)."""
    complete = ~reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    keys = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).withColumn("complete", complete)
    held = target.select(*key).distinct().withColumn("held", F.lit(True))

    def total(of: Column) -> Column:
        return F.coalesce(F.sum(of), F.lit(0))

    copies, complete = F.col("copies"), F.col("complete")
    return keys.join(held, list(key), "left").agg(
        total(F.when(complete, copies)).alias("batch_rows"),
        total(F.when(complete, copies - 1)).alias("copies_in_batch"),
        F.count_if(F.col("held")).alias("already_present"),
        F.count_if(complete & F.col("held").isNull()).alias("inserted"),
        total(F.when(~complete, copies)).alias("without_key"),
    )


def customers_of(enriched: DataFrame) -> DataFrame:
    """Distinct customers for the dimension load."""
    return enriched.select(*CUSTOMERS.names).distinct()


def sales_of(enriched: DataFrame) -> DataFrame:
    """The fact load's columns."""
    return enriched.select(*SALES_TABLE.names)
