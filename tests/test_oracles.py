"""Every registered query against its SQL in DuckDB, value for value."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF = os.environ.get("ORACLE_SF", "0.001")
TABLES = f"/root/testdata/sf{SF}"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(TABLES):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{file}'")
    return con


def rows_of(columns, rows):
    """Rows as sorted tuples with their columns in alphabetical order."""
    places = [columns.index(c) for c in sorted(columns)]
    found = [tuple(row[i] for i in places) for row in rows]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_equals_sql(spark, duck, name):
    ours = driver.queries()[name](spark, TABLES)
    theirs = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = rows_of(columns, theirs.fetchall())
    got = rows_of(ours.columns, [tuple(r) for r in ours.collect()])
    assert len(got) == len(expected)
    for mine, other in zip(got, expected):
        assert mine == other
        assert [type(v) for v in mine] == [type(v) for v in other]


def test_every_query_on_logs_has_sql():
    assert set(driver.QUERIES) <= set(driver.oracle_sql())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
