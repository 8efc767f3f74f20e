"""Every registered query against DuckDB on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.compare import database, differences

SF_DIR = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) is None
    else:
        assert df.count() >= 1


def test_entry(spark):
    assert contract.entry(spark).count() == 2


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(contract.queries())
