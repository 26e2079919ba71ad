"""Adapter from a star schema of order lines, orders and customers."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwise.contracts import MONEY


#: Schemas by session, path and time of change; a stopped session takes its entries along.
_schemas: weakref.WeakKeyDictionary[SparkSession, dict] = weakref.WeakKeyDictionary()


def _schema(spark: SparkSession, path: str) -> StructType:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    key = path, fs.getFileStatus(hadoop_path).getModificationTime()
    known = _schemas.setdefault(spark, {})
    if key not in known:
        known[key] = spark.read.parquet(path).schema
    return known[key]


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of the folder; its schema is looked up once until it changes."""
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def order_heads(orders: DataFrame) -> DataFrame:
    """Order, customer and date of every order."""
    return orders.select(
        F.col("o_orderkey").cast("bigint").alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def sales_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Typed sales lines: one row per order line, price as the line total.

    Where the orders are too large to broadcast, the merge join leaves the lines
    partitioned by order, which the distinct order counts can build on.
    """
    lines = lineitem.select(
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
    )
    return lines.join(order_heads(orders), "order_id").select(
        "order_id", "customer_id", "product_id", "quantity", "price", "order_date"
    )
