"""Every registered query beside its SQL, on the smallest test data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
from checks.compare import TABLES, rows_of
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def database(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, database, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    answer = database.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, answer.fetchall())


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert {"partition_key", "summary_date", "suite_code", "event_type", "n_events", "cents"} == set(df.columns)
