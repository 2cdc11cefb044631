"""Batch rules against a record-at-a-time loop."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardlog.operators import batching, sequence
from shardlog.operators.batching import NO_LIMIT, Rule, _fold, batch_by_count, cut_batches
from shardlog.operators.subscriptions import batch_acks
from shardlog.session import store


def by_hand(rows, rule):
    """[(ts, bytes)] -> [(batch, index)], one record after the other."""
    out, t0, batch, held, size = [], rows[0][0], 0, 0, 0
    for t, b in rows:
        if rule.timeout_us and t >= t0 + rule.timeout_us:
            held = size = 0
            t0 += rule.timeout_us * ((t - t0) // rule.timeout_us)
        if held == 0:
            batch += 1
        out.append((batch, held))
        held, size = held + 1, size + b
        if held >= rule.count or size >= rule.n_bytes:
            held = size = 0
            t0 = t
    return out


@pytest.fixture(autouse=True)
def many_chunks(monkeypatch):
    """Small inputs would be a single chunk, and nothing to put together."""
    monkeypatch.setattr(sequence, "CHUNK_BITS", 5)
    monkeypatch.setattr(batching, "GROUP", 3)


rules = st.builds(
    Rule,
    count=st.integers(1, 6),
    n_bytes=st.one_of(st.just(NO_LIMIT), st.integers(1, 30)),
    timeout_us=st.one_of(st.just(0), st.integers(1, 20)),
)


@settings(max_examples=300, deadline=None)
@given(rules, st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=60), st.data())
def test_fold_of_pieces_equals_loop(rule, steps, data):
    ts = np.cumsum([s for s, _ in steps]).astype("int64") + 100
    size = [b for _, b in steps]
    expected = [i for i, (_, at) in enumerate(by_hand(list(zip(ts.tolist(), size)), rule)) if at == 0]
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(ts) - 1)), max_size=4)))
    state, got, edges = (int(ts[0]) if rule.timeout_us else 0, 0, 0), [], [0, *cuts, len(ts)]
    for a, b in zip(edges, edges[1:]):
        ends = np.concatenate([[0], np.cumsum(size[a:b])]).astype("int64")
        begins, n, after = _fold(ts[a:b], ends, rule, state, 0)
        shared = {}
        assert _fold(ts[a:b], ends, rule, state, 0, shared)[1:] == (n, after)
        assert _fold(ts[a:b], ends, rule, state, 0, shared)[1:] == (n, after)
        got += [a + i for i in begins]
        state = after
    assert got == expected


def _records(n, seed, hot):
    rnd = random.Random(seed)
    rows, t = [], 1_700_000_000_000_000
    for i in range(n):
        t += rnd.choice([0, 1, 5, 40, 900]) * 1000
        shard = 1 if rnd.random() < hot else rnd.randint(2, 4)
        rows.append((i, shard, t, rnd.choice([0, 3, 17, 60])))
    return rows


@pytest.mark.parametrize(
    "rule, proposals",
    [
        (Rule(count=7), 256),
        (Rule(count=50, n_bytes=200), 256),
        (Rule(count=50, n_bytes=200), 2),
        (Rule(count=40, n_bytes=300, timeout_us=50_000), 256),
        (Rule(count=10, timeout_us=300_000), 1),
        (Rule(count=100_000, timeout_us=2_000), 2),
    ],
)
def test_cut_equals_loop(spark, rule, proposals, monkeypatch):
    monkeypatch.setattr(batching, "PROPOSALS", proposals)
    rows = _records(700, 5, 0.7)
    df = spark.createDataFrame(rows, "id bigint, shard_id bigint, us bigint, n bigint").withColumn(
        "ts", F.timestamp_micros("us").cast("timestamp_ntz")
    )
    got = {
        r["id"]: (r["batch_id"], r["batch_index"])
        for r in cut_batches(df, ["shard_id"], "ts", ["id"], "n", rule).records.collect()
    }
    expected = {}
    for shard in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == shard]
        expected.update(zip([r[0] for r in mine], by_hand([(r[2], r[3]) for r in mine], rule)))
    assert got == expected


def test_count_of_25_makes_four_batches_of_100(spark):
    df = spark.range(100).withColumn("shard_id", F.lit(1))
    sizes = batch_by_count(df, ["shard_id"], ["id"], 25).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [(r["batch_id"], r["count"]) for r in sizes] == [(1, 25), (2, 25), (3, 25), (4, 25)]


def test_resumed_cut_equals_one_cut(spark):
    rule = Rule(count=9, n_bytes=150, timeout_us=400_000)
    rows = _records(600, 9, 0.5)
    make = lambda r: spark.createDataFrame(r, "id bigint, shard_id bigint, us bigint, n bigint").withColumn(
        "ts", F.timestamp_micros("us").cast("timestamp_ntz")
    )
    take = lambda cut: {(r["id"], r["rn"], r["batch_id"], r["batch_index"]) for r in cut.records.collect()}
    whole = take(cut_batches(make(rows), ["shard_id"], "ts", ["id"], "n", rule))
    first = cut_batches(make(rows[:250]), ["shard_id"], "ts", ["id"], "n", rule)
    second = cut_batches(make(rows[250:]), ["shard_id"], "ts", ["id"], "n", rule, first.tails)
    assert take(first) | take(second) == whole


def test_parts_are_not_collected(spark, monkeypatch):
    """Acks of many subscriptions: the driver sees single numbers only."""
    acks = spark.range(3000).select(
        (F.col("id") % 1000).cast("string").alias("sub_id"), F.lit(1).cast("bigint").alias("shard_id"), F.col("id").alias("batch_id"), F.lit(0).alias("batch_index"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).cast("timestamp_ntz").alias("acked_at"),
    )
    collect, seen = type(acks).collect, []

    def counted(df):
        rows = collect(df)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(type(acks), "collect", counted)
    cut = batch_acks(acks, 2, 10_000)
    store(cut.records, "requests")
    assert max(seen) <= 1
    n = cut.tails.groupBy("batches", "held").count()
    monkeypatch.undo()
    assert [tuple(r) for r in n.collect()] == [(2, 1, 1000)]


@pytest.mark.parametrize("bad", [{"count": 0}, {"n_bytes": 0}])
def test_rejected_rules(bad):
    with pytest.raises(ValueError):
        Rule(**bad)
