"""Reading and appending to database tables, for callers who have one.

Spark writes one transaction per partition, so a failed append can leave part of
the rows. Append to an empty staging table and merge inside the database, or use
``rows_to_insert`` against the target first; both can be repeated safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.contracts import Contract
from tillwise.operators.conform import conform


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    *,
    split_on: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    splits: int | None = None,
) -> DataFrame:
    """A database table, read in parallel ranges of ``split_on`` where one is given."""
    if split_on is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=split_on, lowerBound=lower, upperBound=upper,
        numPartitions=splits, properties=properties,
    )


def append_jdbc(
    df: DataFrame, contract: Contract, url: str, properties: dict[str, str], table: str | None = None
) -> None:
    """Append rows in the table's declared types; a value that does not fit stops the job."""
    rows = conform(df, contract, narrow=True)
    rows.write.jdbc(url, table or contract.name, mode="append", properties=properties)
