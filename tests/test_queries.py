"""Every registered query against its oracle SQL."""

import os

import pytest

import __spark_entry__ as contract
from compare import difference
from touchline.workload import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SF), SF, ORACLES[name]) is None
