"""Every named query against its SQL counterpart on the whole small tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from riskloom.plans.oracle import oracle_sql
from riskloom.plans.queries import REGISTRY

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001"))


def test_every_query_has_an_oracle():
    assert REGISTRY.keys() == ORACLES.keys()
    assert REGISTRY.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    sf = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
    assert compare(entry.queries()[name](spark, sf), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
