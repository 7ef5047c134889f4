"""Every query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.catalog import CATALOG
from checks.compare import TABLES, frame_rows, sql_types
from checks.oracles import ORACLES

FOLDER = contract.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_each_query_has_sql():
    assert set(CATALOG) == set(ORACLES)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, db, name):
    result, sql = contract.queries()[name](spark, FOLDER), contract.oracle_sql()[name]
    assert dict(result.dtypes) == sql_types(db, sql)
    assert frame_rows(result.toPandas()) == frame_rows(db.execute(sql).df())


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
