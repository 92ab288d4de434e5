"""Every registered query beside its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tools.check import compare, connect
from trendspark.catalog import load

SF = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in contract.queries().items() if name in load()}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in load()}
SLOW = {"train_and_compare", "rfecv", "grid_search"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert compare(duck, QUERIES[name](spark, SF), ORACLES[name]) == "ok"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
