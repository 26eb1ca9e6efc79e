"""Every query agrees with its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from msgmart.workloads import ORACLE, QUERIES

from .oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], FOLDER) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())
