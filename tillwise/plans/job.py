"""The whole job: enrich, check, load two tables, update the totals, publish four metric tables.

All that a batch changes becomes current by one record: readers see the tables before the
batch or after it, never parts of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import contracts as C
from tillwise.operators import metrics as M
from tillwise.operators import totals as S
from tillwise.operators.conform import conform
from tillwise.operators.joins import customer_days, place_days
from tillwise.operators.merge import customers_of, sales_of
from tillwise.operators.spreads import price_quantiles as spread_quantiles
from tillwise.operators.validate import (
    constraint_report,
    contract_rules,
    fail_on_schema,
    fail_on_violations,
    key_conflicts,
    offending_rows,
    passing_rows,
    reference_violations,
    rule_report,
    sale_rules,
)
from tillwise.plans.enrich import enrich
from tillwise.session import AS_ROWS, input_bytes, prepared, scanned_bytes
from tillwise.sinks.tables import ParquetTable, Part
from tillwise.sinks.versions import Publication
from tillwise.sources.files import read_sales_csv, read_sales_csv_checked, read_users_json
from tillwise.sources.lookup import BatchFetch, Fetch, look_up_into
from tillwise.staging import scratch, stage, staged


class Warehouse(NamedTuple):
    """The tables under one folder: six that are the result, and the totals behind the metrics."""

    group: Publication
    tables: dict[str, ParquetTable]
    totals: dict[str, ParquetTable]
    heads: ParquetTable


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    group = Publication(spark, f"{folder}/published")

    def table(contract: C.Contract, **options) -> ParquetTable:
        return ParquetTable(spark, f"{folder}/{contract.name}", contract, group=group, **options)

    plain = (C.CUSTOMERS, C.CUSTOMER_METRICS, C.PRODUCT_METRICS, C.SEASONAL_METRICS, C.MONTHLY_METRICS)
    tables = {c.name: table(c) for c in plain}
    tables["sales"] = table(C.SALES_TABLE, by_month="order_date")
    totals = {c.name: table(c, merge=S.merged(c)) for c in S.ALL}
    return Warehouse(group, tables, totals, table(C.ORDER_HEADS, merge=S.order_heads))


def open_tables(spark: SparkSession, folder: str) -> dict[str, ParquetTable]:
    """The six tables under one folder."""
    return open_warehouse(spark, folder).tables


def run_job(
    spark: SparkSession,
    sales: DataFrame,
    customers: DataFrame,
    known_weather: DataFrame,
    folder: str,
    *,
    fetch: Fetch | BatchFetch | None = None,
    lookup_options: dict | None = None,
    bad_rows: str = "fail",
    no_weather: str = "Unknown",
    quantiles: str = "exact",
    metrics_mode: str = "overwrite",
    metrics_of: str = "table",
) -> dict[str, ParquetTable]:
    """Load one batch of sales.

    The raw sales are read once and written aside with their types, the enriched lines are
    computed once from that; the checks, both loads and all metrics read the copy. All row
    rules are checked in one pass. Before anything is published, the new customers and
    sales are held against the rows already in the tables: a broken key or a sale without
    customer stops the job with all tables unchanged. Then everything is published at once.

    ``bad_rows="quarantine"`` moves offending lines to the folder ``rejected_sales``
    instead of stopping; lines that are there already are not added again. Lines without
    weather appear in the seasonal table under ``no_weather``, which is kept for lines of
    earlier batches. The metrics describe the merged sales table, or the batch alone with
    ``metrics_of="batch"``; ``metrics_mode`` is overwrite, upsert or insert_if_absent. The metrics
    of the table come from totals to which a batch adds its inserted lines, so older sales are not
    read again; they are, once, if the sales were changed by something else than this job. With ``fetch`` the answers are kept in the
    folder ``weather`` and keys that failed are written to ``failed_lookups``.
    """
    if bad_rows not in ("fail", "quarantine"):
        raise ValueError(f"unknown mode {bad_rows!r}")
    if metrics_of not in ("table", "batch"):
        raise ValueError(f"unknown source of metrics {metrics_of!r}")
    rules = {**contract_rules(C.CUSTOMERS), **contract_rules(C.SALES_TABLE), **sale_rules()}
    warehouse = open_warehouse(spark, folder)
    tables = warehouse.tables
    with (
        prepared(spark, AS_ROWS * scanned_bytes(sales, customers)),
        scratch(spark),
        staged(sales, "sales-input") as sales,
    ):
        weather = known_weather
        if fetch is not None:
            keys = place_days(customer_days(sales, customers)).dropna()
            answers = ParquetTable(spark, f"{folder}/weather", C.WEATHER, by_month="order_date")
            weather, failed = look_up_into(answers, keys, known_weather, fetch, **(lookup_options or {}))
            failed.write.mode("overwrite").parquet(f"{folder}/failed_lookups")

        with staged(enrich(sales, customers, weather), "enriched") as lines:
            fail_on_schema(lines, C.ENRICHED_SALE)
            if bad_rows == "quarantine":
                _set_aside(spark, offending_rows(lines, rules), f"{folder}/rejected_sales")
                lines = passing_rows(lines, rules)
            else:
                fail_on_violations(rule_report(lines, rules))
            with warehouse.group.together():
                before = tables["sales"].version()
                inserted = _load(tables, lines)
                _add_up(warehouse, before, inserted, no_weather)
                metrics = _metrics_of_lines(lines, no_weather, quantiles) if metrics_of == "batch" else _metrics(warehouse, quantiles)
                for name, frame in metrics.items():
                    _publish(tables[name], frame, metrics_mode)
    return tables


def _load(tables: dict[str, ParquetTable], lines: DataFrame) -> list[Part]:
    """Insert the new customers and sales, or neither of them; returns the parts of the sales.

    The rows to insert are written once, as loads that do not count before they are checked.
    """
    held, sold = tables["customers"], tables["sales"]
    fresh = conform(sales_of(lines), C.SALES_TABLE)
    with staged(conform(customers_of(lines), C.CUSTOMERS), "customers-batch") as batch:
        new_parts = held.write_load(held.absent(batch, ["username"]))
        sales_parts = sold.write_load(sold.absent(fresh, C.SALES_TABLE.primary_key))
        new, new_sales = held.rows_of(new_parts), sold.rows_of(sales_parts)
        # of all customers, those that the new sales can name
        everyone = held.rows_near(new_sales, ["customer_id"]).select("customer_id").unionByName(new.select("customer_id"))
        # the username cannot break: it is what the customers were merged on
        near = {k: held.rows_near(new, k) for k in C.CUSTOMERS.keys if k != ("username",)}
        reports = [
            constraint_report(batch, C.CUSTOMERS, narrow=False),
            key_conflicts(near, new, C.CUSTOMERS),
            reference_violations(new_sales, "customer_id", everyone, "customer_id"),
        ]
        found = reduce(DataFrame.unionByName, reports)
        fail_on_violations(found.groupBy("rule").agg(F.max("violations").alias("violations")))
    held.add(new_parts)
    sold.add(sales_parts)
    return sales_parts


def _add_up(warehouse: Warehouse, before: int | None, inserted: list[Part], no_weather: str) -> None:
    """Add the inserted sales to the totals, or count all sales if the totals are of other ones.

    The totals note the version of the sales that they were made of.
    """
    sales, heads = warehouse.tables["sales"], warehouse.heads
    notes = {"sales": sales.version()}
    made = [t.manifest().notes.get("sales") for t in (*warehouse.totals.values(), heads)]
    current = before is None or all(version == before for version in made)
    lines = S.measured_lines(sales.rows_of(inserted) if current else sales.rows(), no_weather)
    with staged(S.order_heads(lines), "heads") as new_heads:
        known = S.heads_again(heads.rows_near(new_heads, ["order_id"]) if current else heads.read([]), new_heads)
        with staged(known.select(*C.ORDER_HEADS.names), "known-heads") as known:
            for contract in S.ALL:
                rows, table = S.additions(contract, lines, new_heads, known), warehouse.totals[contract.name]
                if current:
                    table.append(rows, notes)
                else:
                    table.overwrite(rows, notes)
        if current:
            heads.append(new_heads, notes)
        else:
            heads.overwrite(new_heads, notes)


def _metrics(warehouse: Warehouse, quantiles: str) -> dict[str, DataFrame]:
    """The metrics of the merged totals."""

    def totals(contract: C.Contract) -> DataFrame:
        return S.merged(contract)(warehouse.totals[contract.name].rows())

    return {
        C.CUSTOMER_METRICS.name: S.customer_metrics_of(stage(totals(C.CUSTOMER_TOTALS), "customer-totals"), quantiles),
        C.PRODUCT_METRICS.name: S.product_metrics_of(totals(C.PRODUCT_TOTALS)),
        C.SEASONAL_METRICS.name: S.grouped_metrics_of(totals(C.SEASONAL_TOTALS)),
        C.MONTHLY_METRICS.name: S.grouped_metrics_of(totals(C.MONTHLY_TOTALS)),
    }


def price_quantiles(spark: SparkSession, folder: str, probabilities: Sequence[float], **period) -> DataFrame:
    """Quantiles of the line prices of the merged sales, from the sketches of their months.

    Reads a sketch per month and batch and no line; see :func:`tillwise.operators.spreads.price_quantiles`.
    """
    return spread_quantiles(open_warehouse(spark, folder).totals[C.PRICE_SPREADS.name].rows(), probabilities, **period)


def _metrics_of_lines(lines: DataFrame, no_weather: str, quantiles: str) -> dict[str, DataFrame]:
    condition = F.coalesce("weather_condition", F.lit(no_weather))
    return {
        C.CUSTOMER_METRICS.name: M.customer_metrics(lines, mode=quantiles),
        C.PRODUCT_METRICS.name: M.product_metrics(lines),
        C.SEASONAL_METRICS.name: M.seasonal_sales_metrics(lines.withColumn("weather_condition", condition)),
        C.MONTHLY_METRICS.name: M.monthly_sales_metrics(lines),
    }


def _set_aside(spark: SparkSession, rejected: DataFrame, path: str) -> None:
    """Add the rows that the folder does not hold yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        rejected = rejected.exceptAll(spark.read.schema(rejected.schema).parquet(path))
    with staged(rejected, "rejected") as rows:
        rows.write.mode("append").parquet(path)


def run_job_on_files(
    spark: SparkSession,
    sales_csv: str,
    users_json: str,
    known_weather: DataFrame,
    folder: str,
    *,
    user_lines: bool = False,
    unreadable: str = "null",
    **options,
) -> dict[str, ParquetTable]:
    """The job on sales CSV files and user documents; both paths may be patterns.

    A user file holds one array of documents, or with ``user_lines`` one document per line,
    which is read in splits. A field of the sales that cannot be read is null, or its line is
    left out and added to the folder ``unreadable_lines`` (once) with ``unreadable="set_aside"``.
    """
    if unreadable not in ("null", "set_aside"):
        raise ValueError(f"unknown mode {unreadable!r}")
    with prepared(spark, input_bytes(spark, sales_csv, users_json)):
        customers = read_users_json(spark, users_json, multi_line=not user_lines)
        if unreadable == "null":
            sales = read_sales_csv(spark, sales_csv)
        else:
            sales, rejected = read_sales_csv_checked(spark, sales_csv)
            _set_aside(spark, rejected, f"{folder}/unreadable_lines")
        return run_job(spark, sales, customers, known_weather, folder, **options)


def row_counts(tables: dict[str, ParquetTable]) -> DataFrame:
    """(table_name, row_count) of all tables."""
    out = None
    for name, table in tables.items():
        one = table.rows().agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out


def _publish(table: ParquetTable, frame: DataFrame, mode: str) -> None:
    if mode == "overwrite":
        table.overwrite(frame)
    elif mode == "upsert":
        table.upsert(frame, table.contract.primary_key)
    elif mode == "insert_if_absent":
        table.insert_if_absent(frame, table.contract.primary_key)
    else:
        raise ValueError(f"unknown metrics mode {mode!r}")
