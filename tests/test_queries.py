"""Every query against its SQL, and the entry points."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from oracle import connect, difference  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from shardlog.plans.registry import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_entry_points_offer_every_query():
    assert QUERIES.keys() <= entry_points.queries().keys() and ORACLES.keys() <= entry_points.oracle_sql().keys()


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["shard_id", "batch_id", "batch_size", "bytes", "publish_time"]
