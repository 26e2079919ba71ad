"""The queries that SQL can express, held against DuckDB on the smallest tables."""

import duckdb
import pytest
from conftest import SMALL
from test_oracle import TABLES, sql_type

from tillwise.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = Q.queries()[name](spark, SMALL)
    duck.execute(Q.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in duck.description}
    assert {f.name: sql_type(f.dataType.simpleString()) for f in df.schema.fields} == described
    order, at = sorted(described), [d[0] for d in duck.description]
    want = sorted(repr(tuple(r[at.index(c)] for c in order)) for r in duck.fetchall())
    assert want and sorted(repr(tuple(r[c] for c in order)) for r in df.collect()) == want


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in Q.queries()] == [f"op{k}" for k in range(1, 14)]
