"""Every query with SQL against DuckDB on the smallest tables: names, types and values."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def sql_type(spark_type):
    if spark_type.startswith("decimal"):
        return spark_type.upper()
    return TYPES[spark_type]


@pytest.mark.parametrize("name", sorted(E._own_sql()))
def test_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    duck.execute(E.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in duck.description}
    assert {f.name: sql_type(f.dataType.simpleString()) for f in df.schema.fields} == described
    order = sorted(described)
    at = [d[0] for d in duck.description]
    want = sorted(repr(tuple(r[at.index(c)] for c in order)) for r in duck.fetchall())
    got = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    assert want
    assert got == want


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E._own_queries()) - set(E._own_sql()) == {"customer_metrics_approx"}


def test_approximate_segments_stay_within_the_rank_error(spark):
    """Each cut may be off by 5 % of the customers, so a segment by twice that."""
    df = E.queries()["customer_metrics_approx"](spark, SMALL)
    sizes = {r["ltv_segment"]: r["count"] for r in df.groupBy("ltv_segment").count().collect()}
    total = sum(sizes.values())
    assert set(sizes) == {"Low", "Medium", "High", "Very High"}
    assert all(abs(n / total - 0.25) <= 0.1 + 1 / total for n in sizes.values())


def test_entry_is_lazy_frame_with_rows(spark):
    assert E.entry(spark).columns == [
        "customer_id", "ltv", "ltv_segment", "recency", "frequency", "total_revenue",
    ]
    assert E.entry(spark).count() > 0
