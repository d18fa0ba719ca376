"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def twin():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert all(oracle is not None for _, oracle in entry.REGISTRY.values())
    assert set(entry.REGISTRY) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.REGISTRY))
def test_query(spark, twin, name):
    assert compare(spark, twin, SF_DIR, name) is None


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns == ["customer_state", "total_orders", "total_revenue"]
    assert report.count() > 0
