"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from claimstrata.registry.oracles import ORACLES
from claimstrata.registry.queries import QUERIES
from compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 27 and df.columns[0] == "policy_id"
    assert df.count() > 0
