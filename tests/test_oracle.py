"""Every registered query against its DuckDB oracle on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import check, duck  # noqa: E402

from storepulse import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
QUERIES = registry.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = check(spark, con, name, SF, QUERIES[name], SQL[name])
    assert r["names_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
