"""Every registered query against its SQL in DuckDB on the smallest bundled tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check

FOLDER = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="bundled tables not found")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for table in check.TABLES:
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return c


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    _, verdict = check.compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), FOLDER)
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
