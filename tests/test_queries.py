"""Every query against its SQL over the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.oracles import oracles
from palaver.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(oracles()) == set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    fine, note = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SF_DIR)
    assert fine, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0
