"""Every registered query against DuckDB on the smallest driver tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_points
from checks.oracle import ORACLE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{file}'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = _rows(names, cursor.fetchall())
    assert expected and _rows(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
