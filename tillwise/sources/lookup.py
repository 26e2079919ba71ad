"""Keyed lookup of weather documents, spread over partitions.

Only keys that are not known yet are asked for. The caller's ``fetch`` runs
inside the tasks, so neither keys nor answers pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import SALES, WEATHER, SalesColumns
from tillwise.functions.columns import epoch_seconds
from tillwise.sources.documents import parse_weather
from tillwise.staging import stage

Fetch = Callable[[float, float, int], str | None]
BatchFetch = Callable[[list[tuple[float, float, int]]], list[str | None]]

# Simultaneous requests, tries per key and seconds per key.
REQUESTS = 10
ATTEMPTS = 5
MAX_SECONDS = 300.0

OUTCOME = "latitude float, longitude float, order_date date, status string, document string, error string"


def missing_keys(keys: DataFrame, known: DataFrame, cols: SalesColumns = SALES) -> DataFrame:
    """Complete keys without a known answer, each once."""
    wanted = keys.select(*cols.place_day).dropna().distinct()
    return wanted.join(known.select(*cols.place_day), cols.place_day, "left_anti")


def fetch_documents(
    keys: DataFrame,
    fetch: Fetch | BatchFetch,
    *,
    partitions: int = REQUESTS,
    attempts: int = ATTEMPTS,
    max_seconds: float = MAX_SECONDS,
    first_wait: float = 1.0,
    on_error: str = "fail",
    batch_size: int | None = None,
) -> DataFrame:
    """Ask ``fetch(latitude, longitude, epoch_seconds)`` once per key.

    With ``batch_size`` a call gets a list of such triples instead and answers with
    as many documents; its keys are retried and fail together.
    Returns the key with status ``ok``, ``empty`` or ``failed``. An exception is
    retried with doubling waits, unless it has a true ``permanent`` attribute.
    What still fails stops the job or, with ``on_error="skip"``, is reported as
    ``failed``. A rerun task asks again, so ``fetch`` must be safe to repeat.
    Partitions are streamed; their number bounds the simultaneous requests.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"unknown error mode {on_error!r}")

    # self-contained, so that executors need nothing but the caller's function
    def run(batches):
        import random
        import time

        def ask(keys):
            started, wait = time.monotonic(), first_wait
            for attempt in range(1, attempts + 1):
                try:
                    documents = fetch(keys) if batch_size else [fetch(*keys[0])]
                    if len(documents) != len(keys):
                        raise ValueError(f"{len(documents)} answers to {len(keys)} keys")
                    return [("ok" if d else "empty", d or None, None) for d in documents]
                except Exception as problem:
                    spent = time.monotonic() - started + wait > max_seconds
                    if getattr(problem, "permanent", False) or spent or attempt == attempts:
                        if on_error == "fail":
                            raise
                        return [("failed", None, f"{type(problem).__name__}: {problem}")] * len(keys)
                    time.sleep(random.uniform(0, wait))
                    wait *= 2

        step = batch_size or 1
        for batch in batches:
            keys = [(float(a), float(b), int(t)) for a, b, t in zip(batch.latitude, batch.longitude, batch.epoch)]
            asked = [one for i in range(0, len(keys), step) for one in ask(keys[i : i + step])]
            answer = batch[["latitude", "longitude", "order_date"]].copy()
            answer["status"] = [a[0] for a in asked]
            answer["document"] = [a[1] for a in asked]
            answer["error"] = [a[2] for a in asked]
            yield answer

    asked_for = keys.select(
        "latitude", "longitude", "order_date", epoch_seconds("order_date").alias("epoch")
    )
    return asked_for.repartition(partitions, "latitude", "longitude", "order_date").mapInPandas(
        run, OUTCOME
    )


def answered(outcomes: DataFrame) -> DataFrame:
    """Weather rows of the keys that got an answer; empty and failed keys drop out."""
    ok = outcomes.where(F.col("status") == "ok").drop("status", "error")
    return parse_weather(ok, "document").select(*WEATHER.names)


def unanswered(outcomes: DataFrame) -> DataFrame:
    """The keys that could not be asked for, with the error."""
    return outcomes.where(F.col("status") == "failed").select("latitude", "longitude", "order_date", "error")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """(status, keys) of the outcomes."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


def look_up(keys: DataFrame, known: DataFrame, fetch: Fetch | BatchFetch, **options) -> DataFrame:
    """Known answers plus fetched ones.

    The outcomes are written once before they are used, so that no later action
    asks the service again.
    """
    outcomes = stage(fetch_documents(missing_keys(keys, known), fetch, **options), "lookup")
    return known.select(*WEATHER.names).unionByName(answered(outcomes))


def look_up_into(table, keys: DataFrame, known: DataFrame, fetch: Fetch | BatchFetch, **options) -> tuple[DataFrame, DataFrame]:
    """The same with a table that keeps the answers, and the keys that failed.

    ``table`` holds ``WEATHER`` rows and is asked beside ``known``; only its parts near the keys'
    days and places are read, and new answers are added to it without touching the held ones. A
    key whose answer was empty is kept without weather, so that the next run asks for failed and new
    keys only: with none of them nothing is asked or written. The result reads ``known`` and the table.
    """
    known = known.select(*WEATHER.names)
    wanted = stage(keys.select(*SALES.place_day).dropna().distinct(), "lookup-keys")
    asked = stage(missing_keys(wanted, known.unionByName(table.rows_near(wanted, SALES.place_day))), "missing-keys")
    failed = wanted.sparkSession.createDataFrame([], "latitude float, longitude float, order_date date, error string")
    if not asked.isEmpty():
        outcomes = stage(fetch_documents(asked, fetch, **options), "lookup")
        none = outcomes.where(F.col("status") == "empty").select(
            "latitude",
            "longitude",
            "order_date",
            F.lit(None).cast("float").alias("temperature"),
            F.lit(None).cast("string").alias("weather_condition"),
        )
        # their keys are new, so they need not be held against the table again
        table.append(answered(outcomes).unionByName(none))
        failed = unanswered(outcomes)
    held = table.rows_near(wanted, SALES.place_day).join(known.select(*SALES.place_day), SALES.place_day, "left_anti")
    return known.unionByName(held), failed
