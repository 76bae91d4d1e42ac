"""Every catalog query against its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import compare, duck  # noqa: E402

from wordmill.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    status, n, m = compare(spark, con, name, SF)
    assert status == "OK", status


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert 0 < df.count() <= 50
