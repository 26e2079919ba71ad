import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwise import contracts as C  # noqa: E402
from tillwise.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def day(text):
    return dt.date.fromisoformat(text)


SALES_SCHEMA = (
    "order_id long, customer_id long, product_id long, quantity int,"
    " price decimal(18,2), order_date date"
)


@pytest.fixture
def sales_of_rows(spark):
    from decimal import Decimal

    def make(*rows):
        typed = [
            (o, c, p, q, None if m is None else Decimal(str(m)), None if d is None else day(d))
            for o, c, p, q, m, d in rows
        ]
        return spark.createDataFrame(typed, SALES_SCHEMA)

    return make


@pytest.fixture
def customers_of_rows(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), C.CUSTOMERS.schema)

    return make


@pytest.fixture
def weather_of_rows(spark):
    def make(*rows):
        typed = [(a, b, day(d), t, w) for a, b, d, t, w in rows]
        return spark.createDataFrame(typed, C.WEATHER.schema)

    return make


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
