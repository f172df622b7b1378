"""Every registered query against its SQL twin on the small tables."""

import os

import pytest

import __spark_entry__ as entry
from opsreports.checks import QUERIES, SQL
from compare import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
