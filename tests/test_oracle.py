"""Every query gives what its SQL counterpart gives on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL, TABLES
from entry_queries.oracle import oracle
from entry_queries.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')"
        )
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    cursor = duck.execute(entry.oracle_sql()[name])
    expected, names = cursor.fetchall(), [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    found = canonical([tuple(r) for r in df.collect()], df.columns)
    expected = canonical(expected, names)
    assert found == expected
    assert [[type(v) for v in r] for r in found] == [[type(v) for v in r] for r in expected]


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0
