"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from riskloom.plans.oracle import ORACLE
from riskloom.plans.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{Path(sf_dir) / name}.parquet'")
    return connection


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    return round(float(x), 6) if isinstance(x, float) else x


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    result = entry_point.queries()[name](spark, sf_dir)
    expected = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    rows = _sorted(result.collect(), result.columns)
    assert rows and rows == _sorted(expected.fetchall(), columns)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark, sf_dir):
    row = entry_point.entry(spark).first()
    assert row.total_transactions > row.total_suspected_fraud > 0
