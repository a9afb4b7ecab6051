"""Every registered query runs; those with an oracle give its names, types and values."""

import pytest

import __spark_entry__ as driver
from basketstream.plans import oracles, queries
from compare import mismatch, open_tables

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, ORACLES = queries.REGISTRY, oracles.oracle_sql()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def tables():
    connection = open_tables(SMALL)
    yield connection
    connection.close()


# Models need the larger tables: the small ones lack purchases on single days.
FITTED = {"score_batch_summary"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - FITTED))
def test_query_equals_oracle(spark, tables, name):
    assert mismatch(QUERIES[name](spark, SMALL), tables, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted_query_equals_oracle(spark, name):
    assert mismatch(QUERIES[name](spark, MIDDLE), open_tables(MIDDLE), ORACLES[name]) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, MIDDLE).count() > 0


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


def test_names():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
