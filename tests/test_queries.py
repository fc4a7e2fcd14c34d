"""Every registered query against its oracle on the smallest tables."""

from pathlib import Path

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry(spark):
    assert contract.entry(spark).count() == 89


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns and df.count() >= 0
    else:
        assert compare(name, df, duck, sql) is None
