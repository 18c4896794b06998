"""Every query that has an SQL twin gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as driver
from tests.compare import compare, connect

QUERIES, TWINS = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_as_sql(spark, duck, sf_dir, name):
    problem, _ = compare(spark, duck, QUERIES[name], TWINS[name], sf_dir)
    assert problem is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
