"""Sales CSV and user documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.contracts import SALES_CSV, USER_DOCUMENT, Contract
from tillwise.functions.columns import as_date, as_float, as_key


def read_sales_csv(spark: SparkSession, path: str, *, infer: bool = False) -> DataFrame:
    """Sales lines from CSV files with a header.

    Columns are found by name; other columns are left out and a missing one is an
    error. The types are fixed, so the files are read once (but for the first line).
    ``infer`` lets Spark find the types instead, at the price of a second pass. All files of
    the path need the same header, else the read fails. A field that cannot be read is null.
    """
    schema = _csv_schema(spark, path)
    if infer:
        lines = spark.read.csv(path, header=True, inferSchema=True)
    else:
        lines = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return lines.select(*SALES_CSV.names).withColumn("order_date", as_date("order_date"))


def _csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """The header's columns with their types; columns that are not of the sales are text."""
    header = spark.read.csv(path, header=True, enforceSchema=True).columns
    if missing := [f.name for f in SALES_CSV if f.name not in header]:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    types = {f.name: f for f in SALES_CSV}
    return T.StructType([types.get(name, T.StructField(name, T.StringType())) for name in header])


def read_sales_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The sales lines all of whose fields can be read, and ``line, reasons`` of the others.

    ``line`` is the line of the file (put together again where its date alone is wrong), ``reasons``
    are the columns whose text is no value of their type, or ``fields`` where a line has too
    many or too few. An empty field is a null, not a mistake. Otherwise as :func:`read_sales_csv`.
    """
    schema = _csv_schema(spark, path)
    names = schema.names
    lines = spark.read.csv(
        path,
        header=True,
        schema=T.StructType([*schema.fields, T.StructField("_line", T.StringType())]),
        columnNameOfCorruptRecord="_line",
        mode="PERMISSIVE",
        enforceSchema=False,
    )
    # a condition on all fields, always true: a field that is not asked for would not be looked at
    all_read = F.xxhash64(*names).bitwiseAND(F.lit(0)) == 0
    dated = lines.where(all_read).withColumn("_date", as_date("order_date"))
    wrong_date = F.col("order_date").isNotNull() & F.col("_date").isNull()
    whole = F.coalesce("_line", F.to_csv(F.struct(*names)))
    bad = dated.where(F.col("_line").isNotNull() | wrong_date).withColumn("line", whole)
    texts = F.from_csv("line", ", ".join(f"`{n}` STRING" for n in names))
    of_columns = [
        F.when(F.col(f"_texts.{n}").isNotNull() & F.col("_date" if n == "order_date" else n).isNull(), n) for n in SALES_CSV.names
    ]
    reasons = F.array_compact(F.array(*of_columns))
    reasons = F.when(F.size(reasons) == 0, F.array(F.lit("fields"))).otherwise(reasons)
    rejected = bad.withColumn("_texts", texts).select("line", reasons.alias("reasons"))
    good = dated.where(F.col("_line").isNull() & ~wrong_date).withColumn("order_date", F.col("_date"))
    return good.select(*SALES_CSV.names), rejected


def read_users_json(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Customers from user documents.

    One array of documents per file needs ``multi_line``; files with one document
    per line are read in splits and should be preferred for large inputs.
    """
    return flatten_users(spark.read.schema(USER_DOCUMENT).json(path, multiLine=multi_line))


def flatten_users(documents: DataFrame) -> DataFrame:
    """Nested user documents to the customer columns.

    An id that is not a number cannot match any sale and becomes null.
    """
    return documents.select(
        as_key("id").alias("customer_id"),
        "name",
        "username",
        "email",
        as_float("address.geo.lat").alias("latitude"),
        as_float("address.geo.lng").alias("longitude"),
    )


def parse_users(df: DataFrame, column: str) -> DataFrame:
    """Customers from a column that holds one user document as JSON text per row."""
    documents = df.select(F.from_json(column, USER_DOCUMENT).alias("user")).select("user.*")
    return flatten_users(documents)


def frame_of(spark: SparkSession, rows: Iterable[tuple], contract: Contract) -> DataFrame:
    """A few local rows in the columns and types of a contract."""
    return spark.createDataFrame(list(rows), contract.schema)
