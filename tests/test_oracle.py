"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from agora.catalog import ORACLES, QUERIES
from agora.catalog.compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    outcome = compare(spark, duck, SF_DIR, name)
    assert outcome["match"], outcome


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    flagship = entry_points.entry(spark)
    assert flagship.count() > 0
    assert flagship.columns[:3] == ["chosen", "rejected", "split"]
