"""Schemas of the inputs and contracts of the tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG, INT, TEXT, DATE, FLOAT, DOUBLE = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.DateType(),
    T.FloatType(),
    T.DoubleType(),
)
MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)


@dataclass(frozen=True)
class SalesColumns:
    """Names of the columns every operator works on."""

    order: str = "order_id"
    customer: str = "customer_id"
    product: str = "product_id"
    quantity: str = "quantity"
    price: str = "price"
    date: str = "order_date"
    name: str = "name"
    username: str = "username"
    email: str = "email"
    latitude: str = "latitude"
    longitude: str = "longitude"
    temperature: str = "temperature"
    condition: str = "weather_condition"

    @property
    def place_day(self) -> list[str]:
        """Key of the weather lookup."""
        return [self.latitude, self.longitude, self.date]

    @property
    def customer_day(self) -> list[str]:
        return [self.customer, self.date]


SALES = SalesColumns()


@dataclass(frozen=True)
class Column:
    """One table column: working type, declared type and whether null is allowed.

    ``declared`` is the narrower type the table is specified with; the range
    rules and the narrow form of ``conform`` use it.
    """

    name: str
    type: T.DataType
    required: bool = False
    declared: T.DataType | None = None
    max_length: int | None = None


@dataclass(frozen=True)
class Contract:
    """Columns, keys, checks and references of one table."""

    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[tuple[str, ...]]:
        return [k for k in (self.primary_key, *self.unique) if k]


# ---------------------------------------------------------------- input schemas

SALES_CSV = T.StructType(
    [
        T.StructField("order_id", LONG),
        T.StructField("customer_id", LONG),
        T.StructField("product_id", LONG),
        T.StructField("quantity", INT),
        T.StructField("price", MONEY),
        T.StructField("order_date", TEXT),  # read as text so that a bad date becomes null
    ]
)

USER_DOCUMENT = T.StructType(
    [
        T.StructField("id", TEXT),
        T.StructField("name", TEXT),
        T.StructField("username", TEXT),
        T.StructField("email", TEXT),
        T.StructField(
            "address",
            T.StructType(
                [
                    T.StructField(
                        "geo",
                        T.StructType([T.StructField("lat", TEXT), T.StructField("lng", TEXT)]),
                    )
                ]
            ),
        ),
    ]
)

WEATHER_DOCUMENT = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("temp", DOUBLE),
                        T.StructField(
                            "weather",
                            T.ArrayType(T.StructType([T.StructField("main", TEXT)])),
                        ),
                    ]
                )
            ),
        )
    ]
)

# ---------------------------------------------------------------- table contracts
# Lengths, precisions, keys and checks of the tables.

CUSTOMERS = Contract(
    "customers",
    (
        Column("customer_id", LONG, required=True, declared=INT),
        Column("name", TEXT, required=True, max_length=255),
        Column("username", TEXT, required=True, max_length=255),
        Column("email", TEXT, required=True, max_length=255),
        Column("latitude", FLOAT, declared=T.DecimalType(9, 6)),
        Column("longitude", FLOAT, declared=T.DecimalType(9, 6)),
    ),
    primary_key=("customer_id",),
    unique=(("username",), ("email",)),
)

SALES_TABLE = Contract(
    "sales",
    (
        Column("order_id", LONG, required=True, declared=INT),
        Column("customer_id", LONG, required=True, declared=INT),
        Column("product_id", LONG, required=True, declared=INT),
        Column("quantity", INT, required=True),
        Column("price", MONEY, required=True, declared=T.DecimalType(10, 2)),
        Column("order_date", DATE, required=True),
        Column("temperature", FLOAT, declared=T.DecimalType(5, 2)),
        Column("weather_condition", TEXT, max_length=255),
    ),
    primary_key=("order_id", "product_id"),
    checks={
        "quantity_positive": "quantity > 0",
        "temperature_plausible": "temperature BETWEEN -100 AND 100",
    },
    references={"customer_id": ("customers", "customer_id")},
)

WEATHER = Contract(
    "weather",
    (
        Column("latitude", FLOAT, required=True),
        Column("longitude", FLOAT, required=True),
        Column("order_date", DATE, required=True),
        Column("temperature", FLOAT),
        Column("weather_condition", TEXT, max_length=255),
    ),
    primary_key=("latitude", "longitude", "order_date"),
)


def _grouped_sales(name: str, key: str, key_length: int) -> Contract:
    return Contract(
        name,
        (
            Column(key, TEXT, required=True, max_length=key_length),
            Column("total_sales_volume", LONG, declared=INT),
            Column("total_sales_revenue", TOTAL, declared=T.DecimalType(10, 2)),
            Column("average_sales_volume", TOTAL, declared=T.DecimalType(10, 2)),
            Column("order_count", LONG, declared=INT),
        ),
        primary_key=(key,),
    )


MONTHLY_METRICS = _grouped_sales("monthly_sales_metrics", "year_month", 7)
SEASONAL_METRICS = _grouped_sales("seasonal_sales_metrics", "weather_condition", 255)

PRODUCT_METRICS = Contract(
    "product_metrics",
    (
        Column("product_id", LONG, required=True, declared=INT),
        Column("sales_volume", LONG, declared=INT),
        Column("total_revenue", TOTAL, declared=T.DecimalType(10, 2)),
        Column("average_order_quantity", TOTAL, declared=T.DecimalType(10, 2)),
    ),
    primary_key=("product_id",),
)

CUSTOMER_METRICS = Contract(
    "customer_metrics",
    (
        Column("customer_id", LONG, required=True, declared=INT),
        Column("ltv", T.DecimalType(18, 4), declared=T.DecimalType(10, 4)),
        Column("ltv_segment", TEXT, max_length=255),
        Column("recency", INT),
        Column("frequency", LONG, declared=INT),
        Column("total_revenue", TOTAL, declared=T.DecimalType(10, 2)),
    ),
    primary_key=("customer_id",),
)

# ------------------------------------------------------- totals behind the metrics


def _grouped_totals(name: str, key: str) -> Contract:
    return Contract(
        name,
        (
            Column(key, TEXT),
            Column("total_sales_volume", LONG),
            Column("total_sales_revenue", TOTAL),
            Column("counted", LONG),
            Column("order_count", LONG),
        ),
    )


MONTHLY_TOTALS = _grouped_totals("monthly_totals", "year_month")
SEASONAL_TOTALS = _grouped_totals("seasonal_totals", "weather_condition")

PRODUCT_TOTALS = Contract(
    "product_totals",
    (
        Column("product_id", LONG),
        Column("sales_volume", LONG),
        Column("total_revenue", TOTAL),
        Column("counted", LONG),
    ),
)

CUSTOMER_TOTALS = Contract(
    "customer_totals",
    (
        Column("customer_id", LONG),
        Column("total_revenue", TOTAL),
        Column("first_order_date", DATE),
        Column("last_order_date", DATE),
        Column("total_orders", LONG),
    ),
)

#: Sketches of the line prices per month, for quantiles.
PRICE_SPREADS = Contract("price_spreads", (Column("year_month", TEXT), Column("price_sketch", T.BinaryType())))

#: Which customers, months and conditions an order was counted for; its bounds are those of the order ids.
ORDER_HEADS = Contract(
    "order_heads",
    (
        Column("order_id", LONG),
        Column("customer_id", LONG),
        Column("year_month", TEXT),
        Column("weather_condition", TEXT),
    ),
    unique=(("order_id",),),
)

#: What the enriched sale must look like before it is loaded.
ENRICHED_SALE = Contract(
    "enriched_sale",
    (
        Column("order_id", LONG),
        Column("customer_id", LONG),
        Column("product_id", LONG),
        Column("quantity", INT),
        Column("price", MONEY),
        Column("order_date", DATE),
        Column("name", TEXT),
        Column("username", TEXT),
        Column("email", TEXT),
        Column("latitude", FLOAT),
        Column("longitude", FLOAT),
        Column("temperature", FLOAT),
        Column("weather_condition", TEXT),
    ),
)
