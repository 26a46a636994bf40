"""Queries of the subpackage that SQL can express equal DuckDB's answer on the smallest tables."""

import os

import pytest
import verify_oracles

from tianguis.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    if not os.path.isdir(SMALL):
        pytest.skip("no tables")
    ours, theirs = verify_oracles.compare(spark, SMALL, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ours == theirs
