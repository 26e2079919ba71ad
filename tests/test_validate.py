"""Data-quality rules on small frames."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import contracts as C
from tillwise.operators import validate as V
from tillwise.operators.aggregates import duplicate_keys

SALE = (
    "order_id long, customer_id long, product_id long, quantity int, price decimal(18,2), order_date date,"
    " name string, username string, email string, latitude float, longitude float,"
    " temperature float, weather_condition string"
)
GOOD = dict(
    order_id=1, customer_id=1, product_id=1, quantity=1, price=None, order_date=None, name="n", username="u",
    email="a@b.co", latitude=1.0, longitude=1.0, temperature=1.0, weather_condition="Rain",
)


@pytest.fixture
def sale(spark):
    def make(*changes):
        names = [f.strip().split()[0] for f in SALE.replace("decimal(18,2)", "decimal").split(",")]
        return spark.createDataFrame([tuple({**GOOD, **c}[n] for n in names) for c in changes], SALE)

    return make


def report(df, rules=None):
    return dict(rows(V.rule_report(df, rules or V.sale_rules())))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_email_rule(sale, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    df = sale(*[{"email": e} for e in ("a@b.co", "bad", None, "a@b", "x@y.z1", "a b@c.de", "a@b.co ")])
    assert report(df)["email_format"] == 5
    assert report(df)["total_records"] == 7


def test_coordinate_rules_skip_null_and_catch_nan(sale):
    values = (90.0, -90.0, 90.5, None, float("nan"), 200.0)
    got = report(sale(*[{"latitude": v, "longitude": v} for v in values]))
    assert (got["latitude_range"], got["longitude_range"]) == (3, 2)


def test_two_quantity_rules(sale):
    df = sale(*[{"quantity": q} for q in (-1, 0, 1, None)])
    assert report(df)["quantity_negative"] == 1
    assert report(df, V.contract_rules(C.SALES_TABLE))["quantity_positive"] == 2


def test_empty_frame_reports_zero(sale):
    df = sale({}).where("false")
    assert set(report(df).values()) == {0}
    assert set(dict(rows(V.constraint_report(df.select(*C.CUSTOMERS.names), C.CUSTOMERS))).values()) == {0}


def test_contract_rules(sale):
    df = sale(
        {"name": None}, {"name": "x" * 256}, {"username": "y" * 255}, {"customer_id": 2**40}, {"latitude": 1000.0}
    )
    got = report(df, V.contract_rules(C.CUSTOMERS, narrow=True))
    assert (got["name_not_null"], got["name_length"], got["username_length"]) == (1, 1, 0)
    assert (got["customer_id_fits"], got["latitude_fits"], got["longitude_fits"]) == (1, 1, 0)
    got = report(sale({"temperature": 100.5}, {"temperature": None}, {"temperature": 1000.0}), V.contract_rules(C.SALES_TABLE, narrow=True))
    assert (got["temperature_plausible"], got["temperature_fits"], got["price_not_null"]) == (2, 1, 3)


def test_price_beyond_the_declared_width(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(18,2)) AS price FROM VALUES (99999999.99), (100000000.00), (NULL) AS t(v)")
    contract = C.Contract("t", (C.Column("price", C.MONEY, declared=T.DecimalType(10, 2)),))
    assert report(df, V.contract_rules(contract, narrow=True))["price_fits"] == 1


@pytest.mark.parametrize(
    "held, declared",
    [("float", "decimal(5,2)"), ("float", "decimal(9,6)"), ("decimal(18,2)", "decimal(10,2)"),
     ("decimal(18,4)", "decimal(6,2)"), ("double", "decimal(10,4)"), ("bigint", "int")],
)
def test_width_rule_agrees_with_casting(spark, held, declared):
    width = T.DecimalType(*eval(declared[7:])) if declared != "int" else T.IntegerType()
    texts = ["0", "-1", "999.99", "999.994", "999.995", "999.996", "-999.995", "1000", "9999.9949", "9999.995",
             "99999999.99", "100000000", "-100000000", "999999.9999", "999999.99995", "2147483647", "2147483648",
             "-2147483648", "-2147483649", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        (F.col("t").cast("decimal(30,10)") if held == "bigint" else F.col("t")).try_cast(held).alias("x")
    )
    contract = C.Contract("t", (C.Column("x", df.schema["x"].dataType, declared=width),))
    bad = V.contract_rules(contract, narrow=True)["x_fits"]
    both = df.select(F.coalesce(bad, F.lit(False)).alias("rule"), (F.col("x").isNotNull() & F.col("x").try_cast(width).isNull()).alias("cast"), "x")
    assert [tuple(r) for r in both.where("rule <> cast").collect()] == []
    assert both.where("rule").count() > 0


def test_schema_problems(sale):
    assert V.schema_problems(sale({}), C.ENRICHED_SALE) == []
    broken = sale({}).drop("email").withColumn("quantity", F.col("quantity").cast("string"))
    assert V.schema_problems(broken, C.ENRICHED_SALE) == [
        "column quantity is string, expected int", "missing column email",
    ]
    with pytest.raises(V.ValidationError, match="missing column email"):
        V.check_sales(broken, C.ENRICHED_SALE)


def test_fail_fast_names_every_broken_rule(sale):
    V.check_sales(sale({}), C.ENRICHED_SALE)
    with pytest.raises(ValueError, match="email_format: 1, quantity_negative: 2"):
        V.check_sales(sale({"quantity": -1, "email": "bad"}, {"quantity": -4}), C.ENRICHED_SALE)


def test_offending_and_passing_rows_split_the_frame(sale):
    df = sale({"order_id": 1}, {"order_id": 2, "email": "bad", "quantity": -1}, {"order_id": 3, "email": None})
    rules = V.sale_rules()
    assert rows(V.offending_rows(df, rules), "order_id", "broken_rules") == [(2, ["email_format", "quantity_negative"])]
    assert rows(V.passing_rows(df, rules), "order_id") == [(1,), (3,)]


def test_duplicate_keys_ignore_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 3)]
    assert rows(V.key_violations(df, ["a", "b"])) == [("a_b_unique", 2)]


def test_reference_rule_counts_lines(spark):
    df = spark.createDataFrame([(1,), (5,), (5,), (None,)], "customer_id long")
    parents = spark.createDataFrame([(1,), (2,)], "id long")
    assert rows(V.reference_violations(df, "customer_id", parents, "id")) == [("customer_id_reference", 2)]
