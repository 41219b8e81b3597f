"""Every registered query with SQL gives the same rows, columns, types and values on both engines."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
