"""Every registered query with an oracle against DuckDB, and the comparison itself."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import canonical, difference, oracle_connection, oracle_rows, spark_rows

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    problem = difference(spark_rows(entry.queries()[name](spark, SF)), oracle_rows(con, entry.oracle_sql()[name]))
    assert problem is None, problem


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_comparison_sees_differences():
    left = canonical(["b", "a"], [(1, 2.0), (3, None)])
    assert difference(left, canonical(["a", "b"], [(None, 3), (2.0, 1)])) is None
    assert difference(left, canonical(["a", "b"], [(None, 3), (2.0000000001, 1)]))
    assert difference(left, canonical(["a", "b"], [(None, 3)]))
    assert difference(left, canonical(["a", "c"], [(None, 3), (2.0, 1)]))
    assert difference(canonical(["a"], [(True,)]), canonical(["a"], [(1,)]))
    assert difference(canonical(["a"], [(0.0,)]), canonical(["a"], [(-0.0,)]))
