"""Every registered query against DuckDB on the same tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakewarden.oracle import ORACLE
from lakewarden.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    found = _bag(result.columns, result.collect())
    expected_rows = duck.execute(oracle_sql()[name])
    columns = [column[0] for column in expected_rows.description]
    expected = _bag(columns, expected_rows.fetchall())
    assert sorted(columns) == sorted(result.columns)
    assert sum(found.values()) > 0
    assert found == expected


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLE.keys() <= oracle_sql().keys()


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0
