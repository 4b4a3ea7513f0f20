"""Registered queries against their checking SQL, over whole tables of the smallest scale; ``check.py`` does it at any scale."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
# The subpackage llm has tests of its own.
CHOSEN = sorted(q for q in queries() if q != "pipeline" and not q.startswith("op"))


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, database, name):
    outcome = compare(queries()[name], oracle_sql().get(name), spark, database, FOLDER, [])
    assert outcome.startswith("ok"), outcome


def test_every_query_has_checking_sql():
    assert set(CHOSEN) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0
