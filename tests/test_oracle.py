"""Every registered query against its DuckDB twin on the test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.compare import differences, duckdb_over
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

# Lawfully empty results, if any, would compare nothing.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    count, problems = differences(spark, duck, QUERIES[name], ORACLE[name], SF_DIR)
    assert problems == []
    assert count > 0 or name in EMPTY


def test_entry(spark):
    assert driver.entry(spark).count() > 0
