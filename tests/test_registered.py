"""Every registered query against its comparison SQL on the smallest data."""

import os

import pytest

import __spark_entry__ as registered
from hostvane.plans import registry
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    problem = compare(spark, duck, SF_DIR, name, registered.queries()[name], registered.oracle_sql()[name])
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(registry.ORACLES) == set(registry.QUERIES) <= set(registered.queries())


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["machine", "component", "status", "samples"] and result.count() > 0
