"""Every registered query against its oracle text, on the smallest tables."""

from __future__ import annotations

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from verification.compare import database, oracle_rows, spark_rows  # noqa: E402

FOLDER = os.environ.get("DQLOOM_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["constraint_name", "checked_count", "orphan_count", "orphan_pct",
                             "status"]
    assert frame.count() == 1


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, name):
    found = spark_rows(queries()[name](spark, FOLDER))
    sql = oracle_sql().get(name)
    if sql is None:
        assert found[1]
    else:
        assert found == oracle_rows(connection, sql)
