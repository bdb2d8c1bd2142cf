"""Every query with SQL against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows):
    def cell(value):
        return "" if value is None else repr(value) if isinstance(value, float) else str(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    found = driver.queries()[name](spark, str(FOLDER))
    expected = con.sql(driver.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = found.select(*[f"`{c}`" for c in columns]).collect()
    assert canonical(rows) == canonical(expected.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() == 150
