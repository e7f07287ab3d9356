"""Every registered query against its oracle SQL on the smallest tables."""

import os

import check
import pytest

import __spark_entry__ as contract
from rosterline.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, message, _ = check.compare(spark, SF, name, contract.queries()[name], contract.oracle_sql()[name], con)
    assert ok, message


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
