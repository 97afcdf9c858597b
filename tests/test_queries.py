"""Every registered query against its SQL on DuckDB, and the driver contract."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tagloom.plans.queries import ORACLE, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, duck, name):
    found = contract.queries()[name](spark, str(FOLDER))
    expected = duck.sql(contract.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)

    def ordered(rows, names):
        places = [names.index(c) for c in columns]
        return sorted((tuple(row[p] for p in places) for row in rows), key=repr)

    rows = ordered([tuple(r) for r in found.collect()], found.columns)
    assert rows == ordered(expected.fetchall(), expected.columns)
    assert rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert contract.queries()[name](spark, str(FOLDER)).count() > 0
