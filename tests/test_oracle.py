"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from check_queries import difference, duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    mine = spark_rows(QUERIES[name](spark, SF_DIR))
    assert difference(mine, duck_rows(con, ORACLE[name])) is None


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
