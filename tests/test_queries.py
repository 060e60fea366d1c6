"""Every registered query on the smallest tables; those with a SQL twin must agree with it."""

import os

import pytest

import __spark_entry__ as registered
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
ORACLES = registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return connect(SF)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query(spark, con, name):
    df = registered.queries()[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_flagship(spark):
    assert registered.entry(spark).count() > 0
