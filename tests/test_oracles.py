"""Every query with an SQL counterpart, value for value and type for type."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from riskloom.plans import oracles

SQL = oracles.sql_texts()  # the operators of the subpackage are compared in its own tests
QUERIES = contract.queries()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("orders", "customer"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


def ordered(rows, names):
    place = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in place) for r in rows)


def test_every_sql_text_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(name, spark, duck):
    ours = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    rows = cursor.fetchall()
    assert sorted(ours.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in ours.dtypes} == types
    assert ordered([tuple(r) for r in ours.collect()], ours.columns) == ordered(rows, names)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["feature", "category", "Good", "Bad"] and result.count() > 0
