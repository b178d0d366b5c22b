"""Every registered query against its DuckDB counterpart, on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
import parity
from oracle import all_sql
from plumbline.plans.queries import all_queries

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return parity.connect(SF_DIR)


# Queries of the training-data subpackage, where it is installed, have tests of their own.
NAMES = sorted(all_queries())


def test_every_query_has_its_sql():
    assert set(NAMES) == set(all_sql())
    assert set(NAMES) <= set(QUERIES) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_same_result(name, spark, duck):
    assert parity.compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 26
