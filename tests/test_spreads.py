"""Quantiles from sketches of batches that are kept and merged."""

import uuid

import pytest
from conftest import rows

from tillwise import contracts as C
from tillwise.operators.spreads import price_quantiles, price_spreads
from tillwise.operators.totals import merged
from tillwise.plans.job import open_warehouse, run_job
from tillwise.plans.job import price_quantiles as kept_quantiles
from tillwise.sinks.tables import ParquetTable
from tillwise.staging import shared_folder

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/spreads-{uuid.uuid4().hex}"


def lines(spark, n, month="2024-01"):
    return spark.range(n).selectExpr(f"'{month}' AS year_month", "double(pmod(xxhash64(id), 1000003)) AS price")


def test_merged_batches_keep_the_error(spark):
    """Twenty batches of different sizes, one of them sorted, against all values."""
    everything = lines(spark, 40_000)
    batches = [everything.where(f"price % 20 = {i}") for i in range(19)] + [everything.where("price % 20 = 19").sort("price")]
    spreads = price_spreads(batches[0])
    for batch in batches[1:]:
        spreads = spreads.unionByName(price_spreads(batch))
    values = sorted(r["price"] for r in everything.collect())
    found = price_quantiles(spreads, PROBABILITIES).collect()
    assert len(found) == len(PROBABILITIES)
    for r in found:
        assert r["counted"] == len(values)
        below, up_to = sum(v < r["price"] for v in values), sum(v <= r["price"] for v in values)
        assert below <= (r["probability"] + 0.05) * len(values)
        assert up_to >= (r["probability"] - 0.05) * len(values)


def test_few_values_are_exact(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", 2.0), ("b", 7.0)], "year_month string, price double")
    assert rows(price_quantiles(price_spreads(df), [0.0, 0.5, 1.0])) == [
        ("a", 0.0, 1.0, 3), ("a", 0.5, 2.0, 3), ("a", 1.0, 3.0, 3),
        ("b", 0.0, 7.0, 1), ("b", 0.5, 7.0, 1), ("b", 1.0, 7.0, 1),
    ]


def test_nulls_nan_and_nothing(spark):
    df = spark.createDataFrame(
        [("a", None), ("b", float("nan")), ("b", 2.0), (None, 5.0)], "year_month string, price double"
    )
    assert rows(price_quantiles(price_spreads(df), [0.5])) == [("a", 0.5, None, 0), ("b", 0.5, 2.0, 1), (None, 0.5, 5.0, 1)]
    assert price_quantiles(price_spreads(df.limit(0)), [0.5]).collect() == []


def test_a_period_merges_its_months(spark):
    spreads = None
    for i, month in enumerate(["2023-12", "2024-01", "2024-02", "2024-03"]):
        one = price_spreads(spark.createDataFrame([(month, float(10 * i + j)) for j in range(5)], "year_month string, price double"))
        spreads = one if spreads is None else spreads.unionByName(one)
    found = price_quantiles(spreads, [0.0, 1.0], "2024-01", "2024-02", whole_period=True)
    assert rows(found) == [(0.0, 10.0, 10), (1.0, 24.0, 10)]
    assert rows(price_quantiles(spreads, [1.0], until="2023-12")) == [("2023-12", 1.0, 4.0, 5)]


def test_compaction_leaves_one_sketch_a_month(spark, folder):
    table = ParquetTable(spark, folder, C.PRICE_SPREADS, merge=merged(C.PRICE_SPREADS))
    for part in range(3):
        table.append(price_spreads(lines(spark, 3000).where(f"price % 3 = {part}")))
    assert table.rows().count() == 3
    table.compact()
    assert table.rows().count() == 1
    assert price_quantiles(table.rows(), [0.5]).first()["counted"] == 3000


def test_the_job_keeps_sketches_of_all_batches(spark, folder, sales_of_rows, customers_of_rows, weather_of_rows):
    customers = customers_of_rows((1, "n", "u", "u@b.co", 1.0, 2.0))

    def batch(*ids):
        return sales_of_rows(*[(i, 1, 1, 1, i, "2024-01-05" if i < 100 else "2024-02-05") for i in ids])

    run_job(spark, batch(1, 2, 3), customers, weather_of_rows(), folder)
    # order 3 comes again and is not counted twice
    run_job(spark, batch(3, 4, 5, 100), customers, weather_of_rows(), folder)
    want = [("2024-01", 0.5, 3.0, 5), ("2024-02", 0.5, 100.0, 1)]
    found = kept_quantiles(spark, folder, [0.5])
    assert rows(found) == want
    # no line of the sales is read
    assert all("/price_spreads/" in f for f in found.inputFiles())

    # a warehouse whose sketches are of other sales counts everything again
    spreads = open_warehouse(spark, folder).totals[C.PRICE_SPREADS.name]
    spreads.overwrite(spreads.rows().limit(0))
    run_job(spark, batch(101), customers, weather_of_rows(), folder)
    assert rows(kept_quantiles(spark, folder, [0.5])) == [("2024-01", 0.5, 3.0, 5), ("2024-02", 0.5, 100.0, 2)]
