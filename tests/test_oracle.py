"""Every named query against the same question in SQL. ``ORACLE_SF`` lists other
scales, for example ``sf0.001,sf0.1``."""

import os

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from helpers import TESTDATA
from pulseforge.plans import catalog, oracle


@pytest.fixture(scope="module", params=os.environ.get("ORACLE_SF", "sf0.01").split(","))
def side(request):
    sf_dir = f"{TESTDATA}/{request.param}"
    return sf_dir, connect(sf_dir)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, side, name):
    sf_dir, con = side
    assert compare(spark, con, name, sf_dir) is None


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)
    assert set(catalog.QUERIES) <= set(contract.queries()) and set(oracle.ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 3
