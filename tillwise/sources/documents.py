"""Weather documents and other JSON text columns, read with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.contracts import WEATHER_DOCUMENT


def parse_weather(df: DataFrame, column: str) -> DataFrame:
    """Replace a weather document by its first temperature and condition."""
    first = F.get(F.col("_document.data"), 0)
    return (
        df.withColumn("_document", F.from_json(column, WEATHER_DOCUMENT))
        .withColumn("temperature", first["temp"].try_cast("float"))
        .withColumn("weather_condition", F.get(first["weather"], 0)["main"])
        .drop("_document", column)
    )


def json_field(column: str, field: str, to: T.DataType | str) -> Column:
    """One top-level field of a JSON text column, typed; null where it is absent or unreadable."""
    return F.get_json_object(column, f"$.{field}").try_cast(to)
