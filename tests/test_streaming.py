"""Streams over several micro-batches."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shardlog.operators.batching import Rule, cut_batches
from shardlog.operators.packing import pack_batches
from shardlog.session import scratch_path
from shardlog.streaming.fetch import fetch_available, read_fetched
from shardlog.streaming.ingest import batcher, read_batched, run_available, table_stream
from shardlog.streaming.timeouts import timed_out
from shardlog.streaming.views import compact_view, daily_totals, keep_view, read_view, stream_as_select

T0 = datetime(2024, 1, 1)
ROWS = "id bigint, shard_id bigint, ts timestamp_ntz, n_bytes bigint"


def slices(spark, rows, schema, n):
    """Rows as ``n`` files that arrive one after the other."""
    path, size = scratch_path(spark, "arrivals"), -(-len(rows) // n)
    for i in range(n):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def rows(n):
    return [(i, 1 if i % 3 else 2, T0 + timedelta(seconds=i * i % 17 + 20 * i), i % 9) for i in range(n)]


def test_open_batches_survive_micro_batches(spark):
    for rule in (Rule(count=7), Rule(count=6, n_bytes=20, timeout_us=150_000_000)):
        path, out = slices(spark, rows(90), ROWS, 3), scratch_path(spark, "out")
        df = spark.read.parquet(path)
        stream = table_stream(spark, path, df.schema, files_per_trigger=1)
        sink = stream.writeStream.foreachBatch(batcher(out, ["shard_id"], "ts", ["id"], "n_bytes", rule))
        run_available(sink, f"{out}/checkpoint")
        got = read_batched(spark, out, df.schema, ["shard_id"])
        want = cut_batches(df, ["shard_id"], "ts", ["id"], "n_bytes", rule).records
        cols = ["id", "batch_id", "batch_index", "publish_time"]
        assert spark.read.parquet(f"{out}/state").select("epoch").distinct().count() == 3
        assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
        closed = read_batched(spark, out, df.schema, ["shard_id"], flush=False)
        last = {r[0]: r[1] for r in want.groupBy("shard_id").agg(F.max("batch_id")).collect()}
        assert all(r["batch_id"] <= last[r["shard_id"]] for r in closed.collect()) and closed.count() <= 90
        # A micro-batch that runs again replaces what it left.
        again = batcher(out, ["shard_id"], "ts", ["id"], "n_bytes", rule)
        third = spark.createDataFrame(rows(90)[60:], ROWS)
        again(third, 2)
        assert sorted(map(str, read_batched(spark, out, df.schema, ["shard_id"]).select(cols).collect())) == sorted(
            map(str, want.select(cols).collect())
        )


def test_view_follows_the_stream(spark):
    path, out = slices(spark, rows(5000), ROWS, 3), scratch_path(spark, "view")
    df = spark.read.parquet(path)
    stream = table_stream(spark, path, df.schema, files_per_trigger=1)
    schema = keep_view(daily_totals(stream, "ts", ["shard_id"], "n_bytes"), f"{out}/changes", f"{out}/checkpoint")
    got = read_view(spark, f"{out}/changes", schema, ["day", "shard_id"])
    want = df.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "shard_id").agg(
        F.count("*").alias("n"), F.sum("n_bytes").alias("bytes")
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() > 2


SIGNALS = "kind string, shard_id bigint, batch_id bigint, batch_index int, at timestamp_ntz"


def packed_arrivals(spark, bad):
    """Three micro-batches of packed batches: batches 1, 2 and 3 of two shards."""
    rows = [(s, b, i, "k", "RAW", None, bytearray([s, b, i]), T0) for s in (1, 2) for b in (1, 2, 3) for i in (0, 1)]
    fields = "shard_id bigint, batch_id bigint, batch_index int, key string, flag string, attributes map<string,string>, payload binary, publish_time timestamp_ntz"
    packed = pack_batches(spark.createDataFrame(rows, fields), ["shard_id"], "gzip")
    sent = packed.withColumn("batch_size", F.col("batch_size") + F.when(F.expr(bad), 1).otherwise(0))
    path = scratch_path(spark, "packed")
    for b in (1, 2, 3):
        sent.where(F.col("batch_id") == b).coalesce(1).write.mode("append").parquet(path)
    return table_stream(spark, path, sent.schema, files_per_trigger=1)


def fetched(stream, out):
    return {(r["shard_id"], r["batch_id"], r["batch_index"]): bytes(r["payload"]) for r in read_fetched(stream, out, ["shard_id"]).collect()}


def test_fetch_follows_its_policy_for_bad_batches(spark):
    stream = packed_arrivals(spark, "shard_id = 1 and batch_id = 2")
    every = {(s, b, i): bytes([s, b, i]) for s in (1, 2) for b in (1, 2, 3) for i in (0, 1)}
    skip, stop, fail = (scratch_path(spark, name) for name in ("skip", "stop", "fail"))
    assert fetch_available(stream, skip, ["shard_id"])
    assert fetched(stream, skip) == {k: v for k, v in every.items() if k[:2] != (1, 2)}
    bad = spark.read.parquet(f"{skip}/bad").collect()
    assert [(r["shard_id"], r["batch_id"], r["epoch"]) for r in bad] == [(1, 2, 1)]
    # What the stream had before the bad batch stays, and nothing comes after.
    for _ in range(2):
        assert not fetch_available(stream, stop, ["shard_id"], "stop")
        assert fetched(stream, stop) == {k: v for k, v in every.items() if k[1] == 1 or k[:2] == (2, 2)}
    with pytest.raises(StreamingQueryException):
        fetch_available(stream, fail, ["shard_id"], "fail")
    assert set(fetched(stream, fail)) == {k for k in every if k[1] == 1}
    with pytest.raises(ValueError, match="on_error must be"):
        fetch_available(stream, fail, ["shard_id"], "ignore")


def test_streamed_logs_have_a_directory_per_shard(spark):
    path, out = slices(spark, rows(30), ROWS, 3), scratch_path(spark, "out")
    df = spark.read.parquet(path)
    stream = table_stream(spark, path, df.schema, files_per_trigger=1)
    run_available(stream.writeStream.foreachBatch(batcher(out, ["shard_id"], "ts", ["id"], "n_bytes", Rule(count=7))), f"{out}/checkpoint")
    mine = [f for f in spark.read.parquet(f"{out}/records").inputFiles() if "shard_id=2" in f]
    assert len(mine) == 3 and sum(spark.read.parquet(f).count() for f in mine) == 10


SENT = "sub_id string, shard_id bigint, batch_id bigint, batch_index int, delivered_at timestamp_ntz"
HEARD = "sub_id string, shard_id bigint, batch_id bigint, batch_index int, acked_at timestamp_ntz"


def test_timeouts_wait_for_acks_on_their_way(spark):
    at = lambda s: T0 + timedelta(seconds=s)
    sends, heard, out = scratch_path(spark, "sends"), scratch_path(spark, "heard"), scratch_path(spark, "out")

    def arrive(sent, acked):
        spark.createDataFrame([("s", 1, 1, i, at(t)) for i, t in sent], SENT).coalesce(1).write.mode("append").parquet(sends)
        spark.createDataFrame([("s", 1, 1, i, at(t)) for i, t in acked], HEARD).coalesce(1).write.mode("append").parquet(heard)
        late = timed_out(table_stream(spark, sends, spark.read.parquet(sends).schema), table_stream(spark, heard, spark.read.parquet(heard).schema), 100, "50 seconds")
        stream_as_select(late, f"{out}/rows", f"{out}/checkpoint")
        return sorted((r["batch_index"], r["due"]) for r in spark.read.schema(late.schema).parquet(f"{out}/rows").collect())

    # 0 is acked, 1 not, 2 too late, 3 twice, 4 is sent again after its ack
    assert arrive([(0, 0), (1, 1), (2, 2), (3, 3), (4, 4)], [(0, 50), (3, 60), (3, 61), (4, 70)]) == []
    # The clock has passed 1's time, but not by as much as an ack may be late.
    assert arrive([(4, 90), (9, 140)], [(9, 141)]) == []
    # 1's ack arrives late, and within the bound.
    assert arrive([], [(1, 100), (2, 103)]) == []
    got = arrive([(9, 400)], [(9, 401)])
    assert got == [(2, at(102))]


def test_timer_closes_the_last_batch_of_a_quiet_shard(spark):
    rule, out = Rule(count=100, timeout_us=60_000_000), scratch_path(spark, "out")
    first = [(i, 1 + i % 2, T0 + timedelta(seconds=i), 1) for i in range(20)]
    later = [(100 + i, 1, T0 + timedelta(seconds=40 + 10 * i), 1) for i in range(6)]
    cut, schema = batcher(out, ["shard_id"], "ts", ["id"], "n_bytes", rule, late_s=5), spark.createDataFrame(first, ROWS).schema
    closed = lambda: {(r["shard_id"], r["batch_id"]) for r in read_batched(spark, out, schema, ["shard_id"], flush=False).collect()}
    cut(spark.createDataFrame(first, ROWS), 0)
    assert closed() == set()
    cut(spark.createDataFrame(later[:2], ROWS), 1)
    assert closed() == set()
    # At 70 s the clock is at 65 s: shard 1 began at 0 s, and shard 2 at 1 s.
    cut(spark.createDataFrame(later[2:4], ROWS), 2)
    assert closed() == {(1, 1), (2, 1)}
    cut(spark.createDataFrame([(200, 2, T0 + timedelta(seconds=95), 1)], ROWS), 3)
    want = cut_batches(spark.createDataFrame([*first, *later[:4], (200, 2, T0 + timedelta(seconds=95), 1)], ROWS), ["shard_id"], "ts", ["id"], "n_bytes", rule).records
    cols = ["id", "batch_id", "batch_index", "publish_time"]
    got = read_batched(spark, out, schema, ["shard_id"])
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    assert "Window" not in got._jdf.queryExecution().toString()


def test_compacted_views_keep_their_values_and_few_files(spark):
    keys, schema = ["k"], spark.createDataFrame([], "k bigint, n bigint").schema
    changes, plain = scratch_path(spark, "changes"), {}
    for epoch in range(50):
        new = {k: epoch * 100 + k for k in range(epoch % 7, 20, 7)}
        plain.update(new)
        spark.createDataFrame(list(new.items()), schema).coalesce(1).write.mode("overwrite").parquet(f"{changes}/epoch={epoch}")
        if epoch % 5 == 4:
            before = sorted(map(tuple, read_view(spark, changes, schema, keys).collect()))
            compact_view(spark, changes, schema, keys, epoch)
            assert sorted(map(tuple, read_view(spark, changes, schema, keys).collect())) == before == sorted(plain.items())
            # A micro-batch that runs again after its compaction changes nothing.
            compact_view(spark, changes, schema, keys, epoch)
    folders = [d for d in os.listdir(changes) if d.startswith("epoch=")]
    assert len(folders) == 5 and len(os.listdir(f"{changes}/_snapshots")) == len(os.listdir(f"{changes}/_pointers")) == 2
    # One that broke off before its pointer is not read.
    spark.createDataFrame([(1, 1, 49)], "k bigint, n bigint, epoch int").write.parquet(f"{changes}/_snapshots/upto=60")
    assert sorted(map(tuple, read_view(spark, changes, schema, keys).collect())) == sorted(plain.items())
