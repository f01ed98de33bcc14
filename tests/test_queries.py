"""Every registered query against its check SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
from verify import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, db, name):
    df = entry_point.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        assert got
        return
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_point.queries())
