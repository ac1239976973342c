"""Every registered query against its SQL restatement."""

import pytest
from compare import check, duck

import __spark_entry__ as e
from duskwatch.plans.oracle import ORACLES
from duskwatch.plans.workload import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, con, name):
    assert check(spark, con, name, QUERIES[name], ORACLES[name], SF).startswith("ok")
