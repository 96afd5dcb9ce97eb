"""Every registered query against its SQL, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from trendmark.workload.oracle import ORACLE
from trendmark.workload.queries import QUERIES


@pytest.fixture(scope="module")
def database(tiny):
    connection = duckdb.connect()
    for path in Path(tiny).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted(columns), Counter(tuple(row[index] for index in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, tiny, database, name):
    found = QUERIES[name](spark, tiny)
    cursor = database.cursor()
    cursor.execute(ORACLE[name])
    wanted = bag([column[0] for column in cursor.description], cursor.fetchall())
    assert bag(found.columns, [tuple(row) for row in found.collect()]) == wanted


def test_entry(spark):
    assert contract.entry(spark).count() > 0
