"""Every registered query with an oracle matches DuckDB at sf0.001; every
other registered query runs and returns rows."""

import pytest

from tests.oracle_check import compare, duck
from tidemark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SF, con)
    assert ok, msg
