"""Every registered query against its SQL in DuckDB."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "events", "part"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, tables, name):
    got = entry.queries()[name](spark, SF_DIR)
    expected = tables.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).first().asDict() == {"pv": 904, "uv": 15}
