"""Queries with SQL against it, on whole tables."""

import pytest
from oracle import connect, difference

from shardlog.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None
