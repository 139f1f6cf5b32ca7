"""Every registered query against its DuckDB statement on the smallest tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from murmur.catalog.oracle import all_oracles
from murmur.catalog.queries import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ("events", "documents")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    expected = normal(columns, cursor.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    assert normal(frame.columns, frame.collect()) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
