"""The log's directory: commits, tails, positions, expiry, rates and stored subscriptions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shardlog.functions.shards import shard_bounds
from shardlog.model import Offset
from shardlog.operators.batching import Rule
from shardlog.operators.retention import expiry_of_files, keep_backlog, keep_backlog_files
from shardlog.operators.stats import rates
from shardlog.session import scratch_path
from shardlog.sources import append as appending
from shardlog.sources import record_log as rl
from shardlog.sources.append import append
from shardlog.sources.cursors import advance, create_subscription, cursor, fetch
from shardlog.sources.directory import batches_between, commit_path, cut_points, read_directory, record_commit, tails

T0 = datetime(2024, 1, 1)
BOUNDS = shard_bounds(3)
RULE = Rule(count=7)


def rows(spark, a, b):
    return spark.range(a, b).select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("k"), F.col("id") % 20).alias("key"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ts"),
        (F.col("id") % 11).alias("n_bytes"),
    )


@pytest.fixture(scope="module")
def log_path(spark):
    path = scratch_path(spark, "listed")
    for a, b in ((0, 300), (300, 310), (310, 700)):
        append(rows(spark, a, b), path, BOUNDS, RULE)
    return path


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_directory_lists_every_batch(spark, log_path):
    log = spark.read.parquet(log_path)
    want = log.groupBy("shard_id", "batch_id").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b"), F.min("ts").alias("x"), F.max("publish_time").alias("y"))
    listed = read_directory(spark, log_path)
    got = listed.groupBy("shard_id", "batch_id").agg(F.sum("n_records").alias("n"), F.sum("n_bytes").alias("b"), F.min("first_ts").alias("x"), F.max("publish_time").alias("y"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, tails(listed).collect())) == sorted(map(tuple, rl.tail_ids(log).collect()))
    assert {r["commit"] for r in listed.select("commit").collect()} == {0, 1, 2}


def test_appends_and_tails_read_the_directory_alone(spark, log_path):
    assert all("_directory" in f for f in tails(read_directory(spark, log_path)).inputFiles())
    done = append(rows(spark, 700, 720), log_path, BOUNDS, RULE)
    assert done.count() == 20
    assert all("/commit=3/" in f for f in done.inputFiles())


def test_a_lost_or_repeated_commit_leaves_one_copy(spark, monkeypatch):
    path = scratch_path(spark, "lost")
    append(rows(spark, 0, 50), path, BOUNDS, RULE)
    monkeypatch.setattr(appending, "record_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        append(rows(spark, 50, 80), path, BOUNDS, RULE)
    monkeypatch.undo()
    assert read_directory(spark, path).agg(F.sum("n_records")).first()[0] == 50
    append(rows(spark, 50, 90), path, BOUNDS, RULE)
    log = spark.read.parquet(path)
    assert sorted(r["event_id"] for r in log.collect()) == list(range(90))
    for _ in range(2):
        record_commit(spark.read.schema(log.drop("commit").schema).parquet(commit_path(path, 1)), path, 1)
    assert read_directory(spark, path).agg(F.sum("n_records")).first()[0] == 90
    ids = log.select("shard_id", "batch_id", "batch_index").collect()
    assert len(set(ids)) == len(ids) == 90


@pytest.mark.parametrize("n", [1, 6, 7, 8, 50, 133, 10_000])
@pytest.mark.parametrize("start, until", [(Offset.earliest(), Offset.empty()), (Offset.record(3, 4), Offset.record(20, 2)), (Offset.timestamp(T0 + timedelta(seconds=200)), Offset.empty()), (Offset.latest(), Offset.empty())])
def test_positions_agree_with_sorting(spark, log_path, n, start, until, monkeypatch):
    monkeypatch.setattr("shardlog.sources.directory.BUCKET", 4)
    log, listed = spark.read.parquet(log_path).drop("commit"), read_directory(spark, log_path)
    ids = ["shard_id", "batch_id", "batch_index"]
    want = rl.read_shard(log, 2, start, until, n).select(ids).collect()
    got = rl.read_shard(log, 2, start, until, n, listed)
    assert sorted(got.select(ids).collect()) == sorted(want)
    assert "TakeOrdered" not in plan_of(got) and "Window" not in plan_of(got) and "Sort " not in plan_of(got)
    if until.kind == "empty":
        each = rl.first_records_per_shard(log, n, start, listed)
        assert sorted(each.select(ids).collect()) == sorted(rl.first_records_per_shard(log, n, start).select(ids).collect())
        assert "Window" not in plan_of(each)


def test_large_counts_of_a_key_are_cut_by_batches(spark, log_path, monkeypatch):
    log = spark.read.parquet(log_path)
    for n in (1, 9, 20, 35, 500):
        want = [r["event_id"] for r in rl.read_by_key(log, "k7", BOUNDS, count=n).collect()]
        with monkeypatch.context() as m:
            m.setattr(rl, "SORTED_LIMIT", 0)
            assert sorted(r["event_id"] for r in rl.read_by_key(log, "k7", BOUNDS, count=n).collect()) == sorted(want)


def test_a_million_records_of_a_large_shard(spark):
    batches = spark.range(1, 30_001).select(F.lit(1).alias("shard_id"), F.col("id").alias("batch_id"), F.lit(0).alias("first"), F.lit(100).cast("long").alias("n"))
    cut = cut_points(batches, 1_000_000).collect()
    assert [(r.cut_batch, r.cut_index, r.cut_left) for r in cut] == [(10_000, 99, 100)]
    assert [(r.cut_batch, r.cut_index) for r in cut_points(batches, 1_234_501).collect()] == [(12_346, 0)]
    assert cut_points(batches, 3_000_001).count() == 0


def test_first_batches_come_from_the_directory(spark, log_path):
    log, listed = spark.read.parquet(log_path), read_directory(spark, log_path)
    for start in (Offset.earliest(), Offset.record(4, 5)):
        ids = lambda df: sorted(map(tuple, df.select("shard_id", "batch_id", "batch_index").collect()))
        assert ids(rl.read_stream(log, None, start, Offset.empty(), 5, listed)) == ids(rl.read_stream(log, None, start, Offset.empty(), 5))
    assert batches_between(listed, Offset.latest()).count() == 0


@pytest.fixture(scope="module")
def streams(spark):
    """Two streams in hourly files: ``a`` of ten hours, ``b`` of three."""
    path = scratch_path(spark, "streams")
    # Batches of ten minutes.
    made = [(s, 1, 6 * h + i // 10, i % 10, T0 + timedelta(hours=h, minutes=i), 10 + i, T0 + timedelta(hours=h, minutes=i // 10 * 10 + 9)) for s, n in (("a", 10), ("b", 3)) for h in range(n) for i in range(60)]
    df = spark.createDataFrame(made, "stream_name string, shard_id bigint, batch_id bigint, batch_index int, ts timestamp_ntz, n_bytes bigint, publish_time timestamp_ntz")
    for h in range(10):
        rl.write_log(df.where(F.floor(F.col("batch_id") / 6) == h).coalesce(1), path, ["stream_name", "shard_id"])
    record_commit(spark.read.schema(df.schema).parquet(path), path, 0, ["stream_name", "shard_id"])
    return path, df.schema, read_directory(spark, path, "stream_name string, shard_id bigint")


def test_expiry_opens_no_file_that_has_expired(spark, streams):
    path, schema, listed = streams
    now = T0 + timedelta(hours=10)
    backlog = {"a": 5 * 3600 + 1800, "b": 0}
    keeps = {(r.stream_name, r.keeps): r.n for r in expiry_of_files(listed, backlog, now).groupBy("stream_name", "keeps").agg(F.count("*").alias("n")).collect()}
    assert keeps == {("a", "none"): 4, ("a", "some"): 1, ("a", "all"): 5, ("b", "none"): 3}
    kept = keep_backlog_files(listed, path, schema, backlog, now)
    assert len(kept.inputFiles()) == 6
    log = spark.read.schema(schema).parquet(path)
    for backlog in (backlog, {"a": 0, "b": 0}, {}, {"b": 10**9}, {"a": 1}):
        got, want = keep_backlog_files(listed, path, schema, backlog, now), keep_backlog(log, backlog, now)
        assert sorted(map(str, got.select("stream_name", "ts").collect())) == sorted(map(str, want.select("stream_name", "ts").collect()))


def test_backlog_bound_reaches_the_scan(spark, streams):
    path, schema, _ = streams
    flat = scratch_path(spark, "flat")
    spark.read.schema(schema).parquet(path).write.parquet(flat)
    plan = plan_of(keep_backlog(spark.read.parquet(flat), {"a": 60, "b": 3600}, T0 + timedelta(hours=10)))
    assert "GreaterThanOrEqual(publish_time,2024-01-0" in plan.split("PushedFilters")[1]


@pytest.mark.parametrize("method", ["append_in_bytes", "append_in_records", "append_in_batches"])
def test_rates_by_the_directory(spark, streams, method):
    path, schema, listed = streams
    log = spark.read.schema(schema).parquet(path)
    for as_of in (T0 + timedelta(hours=10), T0 + timedelta(hours=2, minutes=30), T0 - timedelta(days=1), T0 + timedelta(days=9)):
        for stream in (None, "b"):
            want = rates(log, method, [60, 5400, 10**6], as_of, stream)
            got = rates(log, method, [60, 5400, 10**6], as_of, stream, listed)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    if method == "append_in_batches":
        assert all("_directory" in f for f in got.inputFiles())


def test_a_subscription_survives_a_restart(spark):
    path = scratch_path(spark, "subscribed")
    schema = append(rows(spark, 0, 40), path, BOUNDS, RULE).drop("rid", "error").schema
    create_subscription(spark, path, "new/one")
    create_subscription(spark, path, "all", "earliest")
    with pytest.raises(Exception, match="(?i)already exists"):
        create_subscription(spark, path, "all", "latest")
    with pytest.raises(ValueError, match="no subscription"):
        fetch(spark, path, "none", schema)
    assert fetch(spark, path, "new/one", schema).count() == 0
    append(rows(spark, 40, 90), path, BOUNDS, RULE)
    got = fetch(spark, path, "new/one", schema)
    assert sorted(r["event_id"] for r in got.collect()) == list(range(40, 90))
    assert all("/commit=1/" in f for f in got.inputFiles() if "_subscriptions" not in f and "tails" not in f)
    advance(spark, path, "new/one", got.where("shard_id <> 2"))
    left = [r["event_id"] for r in fetch(spark, path, "new/one", schema).collect()]
    assert sorted(left) == sorted(r["event_id"] for r in got.where("shard_id = 2").collect())
    # A position given late does not move it back.
    advance(spark, path, "new/one", got.where("shard_id = 1").limit(1))
    assert fetch(spark, path, "new/one", schema).count() == len(left)
    assert fetch(spark, path, "all", schema).count() == 90
    assert cursor(spark, path, "all").count() == 0


def test_positions_of_random_counts(spark):
    rng = random.Random(8)
    counts = [(p, b, rng.randrange(5), rng.randrange(1, 9)) for p in (1, 2) for b in rng.sample(range(20_000), 300)]
    df = spark.createDataFrame(counts, "shard_id bigint, batch_id bigint, first int, n bigint")
    for n in (1, 100, 1000, 1400):
        want = set()
        for p in (1, 2):
            left = n
            for _, b, first, held in sorted(c for c in counts if c[0] == p):
                if left <= held:
                    want.add((p, b, first + left - 1, left))
                    break
                left -= held
        assert {tuple(r) for r in cut_points(df, n).collect()} == want
