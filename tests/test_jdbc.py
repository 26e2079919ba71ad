"""The JDBC calls, with Spark's reader and writer replaced: no database may be started here."""

from decimal import Decimal

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter

from tillwise import contracts as C
from tillwise.sinks.jdbc import append_jdbc, read_jdbc

URL, LOGIN = "jdbc:postgresql://host/db", {"user": "u"}


@pytest.fixture
def calls(monkeypatch, spark):
    seen = []

    def write(self, url, table, mode=None, properties=None):
        seen.append((url, table, mode, properties, self._df.collect()))

    def read(self, url, table, **options):
        seen.append((url, table, options))
        return spark.range(1)

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    return seen


def test_append_narrows_to_the_declared_types(spark, calls):
    df = spark.sql("SELECT 7L AS product_id, 3L AS sales_volume, CAST(1.5 AS DECIMAL(28,2)) AS total_revenue, 1.005D AS average_order_quantity")
    append_jdbc(df, C.PRODUCT_METRICS, URL, LOGIN)
    url, table, mode, login, written = calls[0]
    assert (url, table, mode, login) == (URL, "product_metrics", "append", LOGIN)
    assert [tuple(r) for r in written] == [(7, 3, Decimal("1.50"), Decimal("1.01"))]
    assert append_jdbc(df, C.PRODUCT_METRICS, URL, LOGIN, "other") is None and calls[1][1] == "other"


def test_value_too_wide_for_the_table_stops_the_append(spark, calls):
    df = spark.sql(f"SELECT {2**31}L AS product_id, 3L AS sales_volume, CAST(1.5 AS DECIMAL(28,2)) AS total_revenue, 1D AS average_order_quantity")
    with pytest.raises(Exception, match="product_metrics.product_id does not fit int"):
        append_jdbc(df, C.PRODUCT_METRICS, URL, LOGIN)


def test_read_in_one_piece_or_in_ranges(spark, calls):
    read_jdbc(spark, URL, "sales", LOGIN)
    read_jdbc(spark, URL, "sales", LOGIN, split_on="order_id", lower=0, upper=100, splits=4)
    assert calls[0] == (URL, "sales", {"properties": LOGIN})
    assert calls[1][2] == {
        "column": "order_id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4, "properties": LOGIN,
    }
