"""Subscriptions and statistics, by hand."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shardlog.operators import subscriptions as s
from shardlog.operators.sequence import running_peak, with_position
from shardlog.operators.stats import rates, requested_stats
from shardlog.plans import subscribing

T0 = datetime(2024, 1, 1)
D = "sub_id string, consumer_name string, shard_id bigint, batch_id bigint, batch_index int, n_bytes bigint, delivered_at timestamp_ntz"
A = "sub_id string, shard_id bigint, batch_id bigint, batch_index int, acked_at timestamp_ntz"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture
def sent(spark):
    return spark.createDataFrame([("s", "c", 1, b, i, 5, at(b)) for b in (1, 2, 3) for i in (0, 1)], D)


def acked(spark, *pairs):
    return spark.createDataFrame([("s", 1, b, i, at(t)) for b, i, t in pairs], A)


def test_unacked_and_frontier(spark, sent):
    acks = acked(spark, (1, 0, 5), (1, 1, 6), (2, 0, 7), (2, 0, 9), (3, 0, 8), (3, 1, 8))
    assert [(r["batch_id"], r["batch_index"]) for r in s.unacked(sent, acks).collect()] == [(2, 1)]
    assert s.commit_frontier(sent, acks).first()["committed_batch"] == 1
    assert s.commit_frontier(sent, acks.unionByName(acked(spark, (2, 1, 9)))).first()["committed_batch"] == 3
    assert s.commit_frontier(sent, acked(spark, (3, 0, 5))).first()["committed_batch"] == 0


def test_redeliveries_stop_with_the_ack_and_the_clock(spark, sent):
    acks = acked(spark, (1, 0, 11), (1, 1, 12), (2, 0, 25), (2, 0, 40))
    got = s.redeliveries(sent, acks, 10, at(33)).collect()
    seconds = lambda t: (t - T0).seconds
    seen = sorted((r["batch_id"], r["batch_index"], r["n_resends"], seconds(r["first_resend"]), seconds(r["last_resend"])) for r in got)
    # 1-0 was acked just in time at 11
    assert seen == [(1, 1, 1, 11, 11), (2, 0, 2, 12, 22), (2, 1, 3, 12, 32), (3, 0, 3, 13, 33), (3, 1, 3, 13, 33)]


def test_resends_of_a_day_are_all_counted(spark, sent):
    got = s.redeliveries(sent, acked(spark), 600, at(86_410)).collect()
    assert [r["n_resends"] for r in got] == [144] * 6


def test_last_send_of_a_day_has_the_number_of_all_sends(spark, sent):
    got = subscribing._attempts(sent, acked(spark, (1, 0, 5), (1, 1, 1300)), at(86_410)).collect()
    seen = {(r["batch_id"], r["batch_index"], r["attempt"], (r["delivered_at"] - T0).total_seconds()) for r in got}
    first = {(b, i, 1, float(b)) for b in (1, 2, 3) for i in (0, 1)}
    last = {(b, i, 145, b + 86_400.0) for b in (2, 3) for i in (0, 1)}
    assert seen == first | last | {(1, 1, 3, 1201.0)} and len(got) == len(seen)


def test_repeated_acks_count_once_in_flight(spark, sent):
    got = s.inflight_peaks(sent, acked(spark, (1, 0, 60), (1, 0, 61), (1, 0, 62), (9, 9, 61)), "minute").collect()
    assert {r["minute"]: r["max_inflight"] for r in got} == {at(0): 6, at(60): 5}


def test_ack_latency(spark, sent):
    got = s.ack_latency(sent, acked(spark, (1, 0, 11), (1, 1, 12), (2, 0, 4)), 10).first()
    assert (got["n_on_time"], got["n_late"], got["n_missing"]) == (2, 1, 3) and got["avg_s"] == pytest.approx(23 / 3)


def test_running_peak_equals_a_loop(spark):
    rnd = random.Random(3)
    steps = [("a" if rnd.random() < 0.8 else "b", at(rnd.randint(0, 600)), rnd.choice([1, 1, -1])) for _ in range(800)]
    expected = {}
    for sub in "ab":
        level = 0
        for _, t, step in sorted(x for x in steps if x[0] == sub):
            level += step
            k = (sub, t.replace(second=0))
            expected[k] = max(expected.get(k, -10**9), level)
    df = spark.createDataFrame(steps, "sub_id string, t timestamp_ntz, step int")
    got = {(r["sub_id"], r["minute"]): r["peak"] for r in running_peak(df, ["sub_id"], "t", "step").collect()}
    assert got == expected


def test_positions_without_parts(spark):
    rows = with_position(spark.range(500), [], ["id"], "n").collect()
    assert all(r["n"] == r["id"] + 1 for r in rows)


def test_latest_subscription_gets_only_later_records(spark):
    rows = [(1, b, i, at(100 * b)) for b in (1, 2) for i in range(10)] + [(2, 1, 0, at(300))]
    log = spark.createDataFrame(rows, "shard_id bigint, batch_id bigint, batch_index int, publish_time timestamp_ntz")
    got = s.start_position(log, "latest", at(150)).collect()
    assert len(got) == 11 and {(r["shard_id"], r["batch_id"]) for r in got} == {(1, 2), (2, 1)}
    assert s.start_position(log, "earliest").count() == 21
    with pytest.raises(ValueError):
        s.start_position(log, "middle")


def test_acks_are_sent_by_hundred_or_after_five_seconds(spark):
    acks = spark.createDataFrame([("s", 1, n, 0, at(n / 100)) for n in range(250)] + [("s", 1, 999, 0, at(9))], A)
    sizes = s.batch_acks(acks).records.groupBy("request_id").count().orderBy("request_id").collect()
    assert [r["count"] for r in sizes] == [100, 100, 50, 1]


def test_unknown_stats_are_error_rows_and_known_ones_without_values_are_not(spark):
    stats = spark.createDataFrame([("append_total", "s", 4)], "stat string, entity string, value bigint")
    got = {r["stat"]: (r["value"], r["error"]) for r in requested_stats(stats, ["append_total", "received_acks", "sighs"]).collect()}
    assert got == {"append_total": (4, None), "received_acks": (None, None), "sighs": (None, "unknown stat type")}


def test_rates_end_at_their_time(spark):
    log = spark.createDataFrame(
        [("a", 1, 1, 3, 30, at(95)), ("a", 1, 2, 0, 999, at(500)), ("b", 1, 1, 0, 7, at(300))],
        "stream_name string, shard_id bigint, batch_id bigint, batch_index int, n_bytes bigint, ts timestamp_ntz",
    )
    got = {r["stream_name"]: r["rate"] for r in rates(log, "append_in_bytes", [100], at(100)).collect()}
    assert got == {"a": 0.3, "b": 0.0}
    # A batch of which the log has not the first record is a batch all the same.
    assert {r["stream_name"]: r["rate"] for r in rates(log, "append_in_batches", [100], at(100)).collect()} == {"a": 0.01, "b": 0.0}


def test_rates_keep_the_order_of_intervals_and_idle_streams(spark):
    log = spark.createDataFrame(
        [("a", 1, 0, 10, at(0)), ("a", 1, 1, 30, at(95)), ("b", 1, 0, 7, at(1))],
        "stream_name string, batch_id bigint, batch_index int, n_bytes bigint, ts timestamp_ntz",
    )
    got = {(r["stream_name"], r["ord"]): r["rate"] for r in rates(log, "append_in_bytes", [100, 10], at(100)).collect()}
    assert got == {("a", 0): 0.3, ("a", 1): 3.0, ("b", 0): 0.07, ("b", 1): 0.0}
    with pytest.raises(ValueError):
        rates(log, "append_in_colours", [1], at(1))


def test_counts_of_consumers(spark, sent):
    got = s.consumers_of(sent.withColumn("consumer_name", F.concat(F.lit("c"), F.col("batch_id") % 2))).collect()
    assert {r["consumer_name"]: r["n_batches"] for r in got} == {"c0": 1, "c1": 2}
    part = s.consumers_of(sent.where("batch_index = 1").withColumn("consumer_name", F.lit("c"))).first()
    assert part["n_batches"] == 3


def test_resends_run_from_the_latest_send(spark):
    sends = spark.createDataFrame([("s", "c", 1, 1, 0, 5, at(t)) for t in (0, 100, 1500)], D)
    # The send at 1500 is behind the clock.
    got = s.redeliveries(sends, acked(spark), 600, at(1300)).collect()
    assert [(r["n_resends"], r["first_resend"], r["last_resend"]) for r in got] == [(2, at(700), at(1300))]
    numbered = subscribing._attempts(sends.where(F.col("delivered_at") <= F.lit(str(at(1300))).cast("timestamp_ntz")), acked(spark), at(1300)).collect()
    assert sorted((r["attempt"], r["delivered_at"]) for r in numbered) == [(1, at(0)), (2, at(100)), (4, at(1300))]
