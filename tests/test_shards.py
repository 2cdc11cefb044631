"""Key hashing and shard lookup."""

import hashlib

import pytest
from pyspark.sql import functions as F

from shardlog.functions.shards import (
    HASH_SPACE, assign_shards, hash_key, shard_bounds, shard_of, shards_frame, split_unassigned,
)
from shardlog.sources.record_log import shard_profile


@pytest.mark.parametrize("n", [1, 2, 5, 500])
def test_bounds_cover_the_space(n):
    bounds = shard_bounds(n)
    assert [b[0] for b in bounds] == list(range(1, n + 1))
    assert int(bounds[0][1], 16) == 0 and int(bounds[-1][2], 16) == HASH_SPACE - 1
    assert all(int(a[2], 16) + 1 == int(b[1], 16) for a, b in zip(bounds, bounds[1:]))


def test_no_shards_is_rejected():
    with pytest.raises(ValueError):
        shard_bounds(0)


def keys(spark, n=2000):
    return spark.range(n).select(F.concat(F.lit("key-"), "id").alias("key")).withColumn("hash_key", hash_key(F.col("key")))


def by_hand(key, bounds):
    h = hashlib.md5(key.encode()).hexdigest()
    below = [(start, shard) for shard, start, _ in bounds if start <= h]
    return max(below)[1] if below else None


@pytest.mark.parametrize("form", ["cases", "prefix"])
@pytest.mark.parametrize("n, dropped", [(1, ()), (5, ()), (60, (7, 8, 30)), (60, (1, 2))])
def test_floor_lookup(spark, form, n, dropped):
    bounds = [b for b in shard_bounds(n) if b[0] not in dropped]  # gaps go to the shard before them
    rows = assign_shards(keys(spark), bounds, form=form).collect()
    assert len(rows) == 2000
    assert all(r["shard_id"] == by_hand(r["key"], bounds) == shard_of(r["key"], bounds) for r in rows)


def test_keys_below_all_shards_are_set_aside(spark):
    bounds = shard_bounds(4)[1:]
    good, lost = split_unassigned(assign_shards(keys(spark), bounds))
    assert good.count() + lost.count() == 2000 and lost.count() > 300
    assert {r["error"] for r in lost.select("error").distinct().collect()} == {"no shard for key"}


def test_profile_lists_empty_shards(spark):
    bounds = shard_bounds(50)
    rows = assign_shards(keys(spark, 20).withColumn("n_bytes", F.lit(3)), bounds)
    got = shard_profile(rows, shards_frame(spark, bounds), 10).collect()
    assert [r["shard_id"] for r in got] == list(range(1, 51))
    assert sum(r["records"] for r in got) == 20 and sum(r["bytes"] for r in got) == 60
    assert any(r["records"] == 0 and r["batches"] == 0 for r in got)


@pytest.mark.parametrize("n", [64, 65])
def test_an_empty_first_start_is_zero(spark, n):
    bounds = shard_bounds(n)
    open_ = [(bounds[0][0], "", bounds[0][2]), *bounds[1:]]
    got = assign_shards(keys(spark, 200), open_).collect()
    assert all(r["shard_id"] == by_hand(r["key"], bounds) for r in got)
