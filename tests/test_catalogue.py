"""Every catalogue query against its SQL on the small tables."""

import pytest

import __spark_entry__ as contract
from postlane.plans.catalogue import all_queries
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(all_queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR)
    assert difference(found, duck, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 2
