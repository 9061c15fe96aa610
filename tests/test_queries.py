"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck
from checks.oracles import ORACLES
from checks.spark_queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ONE_DAY = {"daily_orders", "daily_head", "landing_orders_day", "fct_orders_incremental"}  # empty at a tiny scale

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.queries().keys() >= QUERIES.keys() and contract.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", [n for n in QUERIES])
def test_query(spark, con, name):
    result = compare(spark, con, SF, name)
    assert result["same"], result
    assert result["rows"] > 0 or name in ONE_DAY


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "report_date" and df.count() > 0
