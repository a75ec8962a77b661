import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = sorted(name.removesuffix(".parquet") for name in os.listdir(FOLDER))


@pytest.fixture(scope="module")
def second_engine():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def text(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, second_engine, name):
    df = contract.queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    cursor = second_engine.execute(sql)
    expected = cursor.fetchall()
    assert canonical(df.columns, rows) == canonical([d[0] for d in cursor.description], expected)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
