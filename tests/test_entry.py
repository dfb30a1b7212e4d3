"""Registered queries against SQL on the smallest sample tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


CORE = sorted(query.__name__ for query in entry._QUERIES)


def test_every_query_has_its_sql():
    assert set(CORE) <= set(entry.queries())
    assert set(CORE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CORE)
def test_query_equals_sql(spark, sql, name):
    got = entry.queries()[name](spark, FOLDER)
    cursor = sql.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    expected = sorted(map(str, cursor.fetchall()))
    assert sorted(columns) == sorted(got.columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == expected
    assert expected
