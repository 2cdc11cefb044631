"""Reads, retention and reconciling on a small log of known content."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shardlog.functions.ids import parse_record_id, record_id_text
from shardlog.functions.shards import assign_shards, hash_key, shard_bounds, shard_of, shards_frame
from shardlog.model import Offset, check_stream, check_subscription
from shardlog.operators.batching import Rule, batch_by_count, stamp_publish_time
from shardlog.operators.reconcile import reconcile
from shardlog.operators.retention import keep_backlog, parse_ids, trim_points, trim_shard, trim_shards, trim_stream
from shardlog.session import scratch_path
from shardlog.sources import record_log as rl
from shardlog.sources.append import append
from shardlog.sources.export import export_records, import_records

T0 = datetime(2024, 1, 1)
BOUNDS = shard_bounds(3)


def make_log(spark, n, bounds, size):
    rows = spark.range(n).select(
        "id",
        F.lit("s").alias("stream_name"),
        F.concat(F.lit("k"), F.col("id") % 20).alias("key"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ts"),
    )
    rows = assign_shards(rows.withColumn("hash_key", hash_key(F.col("key"))), bounds)
    cut = stamp_publish_time(batch_by_count(rows, ["shard_id"], ["ts", "id"], size), ["shard_id"])
    path = scratch_path(spark, "testlog")
    rl.write_log(cut, path)
    return spark.read.schema(cut.schema).parquet(path)


@pytest.fixture(scope="module")
def log(spark):
    return make_log(spark, 300, BOUNDS, 7).cache()


@pytest.fixture(scope="module")
def one(spark):
    return make_log(spark, 100, shard_bounds(1), 10).cache()


def ids(df):
    return sorted((r["shard_id"], r["batch_id"], r["batch_index"]) for r in df.collect())


def test_indexes_run_from_zero_and_only_the_last_batch_is_short(log):
    sizes = {}
    for s, b, i in ids(log):
        assert i == len(sizes.setdefault((s, b), []))
        sizes[(s, b)].append(i)
    last = {s: max(b for t, b in sizes if t == s) for s, _ in sizes}
    assert all(len(v) == 7 for (s, b), v in sizes.items() if b != last[s])


@pytest.mark.parametrize("idx", [0, 1, 37, 99])
def test_from_a_record_leaves_total_minus_idx(one, idx):
    start = Offset.record(idx // 10 + 1, idx % 10)
    assert rl.read_shard(one, 1, start, max_records=0).count() == 100 - idx


def test_offsets(one, log):
    assert rl.read_stream(one, "s", Offset.earliest(), Offset.empty(), 1000).count() == 100
    assert rl.read_stream(one, None, Offset.empty(), Offset.latest(), 0).count() == 100
    assert rl.read_stream(one, None, Offset.latest()).count() == 0
    assert rl.read_stream(one, None, Offset.earliest(), Offset.earliest()).count() == 0
    assert rl.read_stream(one, None, Offset.record(99, 0)).count() == 0  # past the end is legal
    assert rl.read_stream(one, None, Offset.record(2, 0), Offset.record(3, 4)).count() == 15
    # The batch that holds second 25 was published at 29 and is read whole.
    at = Offset.timestamp(T0 + timedelta(seconds=25))
    assert rl.read_stream(one, None, at).agg(F.min("batch_id")).first()[0] == 3
    assert rl.read_stream(one, None, Offset.timestamp(1_704_067_200_000 + 25_000)).count() == 80


def test_limits(one, log):
    assert rl.read_shard(one, 1).count() == 1
    assert [r["batch_index"] for r in rl.read_shard(one, 1, Offset.record(2, 3), max_records=4).collect()] == [3, 4, 5, 6]
    got = ids(rl.read_stream(log, None, max_batches=4))
    assert sorted({(b, s) for s, b, _ in got}) == [(1, 1), (1, 2), (1, 3), (2, 1)] and len(got) == 28
    # A batch entered in its middle still counts as one.
    assert rl.read_stream(one, None, Offset.record(2, 5), max_batches=2).count() == 15
    assert {r["shard_id"]: r["count"] for r in rl.first_records_per_shard(log, 5).groupBy("shard_id").count().collect()} == {1: 5, 2: 5, 3: 5}


def test_single_shard_reads_check_the_shards(spark, one, log):
    assert rl.read_single_shard(one, shards_frame(spark, shard_bounds(1))).count() == 100
    with pytest.raises(ValueError, match="too many shards"):
        rl.read_single_shard(log, shards_frame(spark, BOUNDS))


def test_key_reads_touch_one_shard(spark, log):
    path = scratch_path(spark, "keyed")
    rl.write_log(log, path)
    stored = spark.read.schema(log.schema).parquet(path)
    got = rl.read_by_key(stored, "k7", BOUNDS, count=4)
    assert [r["id"] for r in got.collect()] == [7, 27, 47, 67]
    files = rl.read_by_key(stored, "k7", BOUNDS).select(F.input_file_name()).distinct().collect()
    assert all(f"shard_id={shard_of('k7', BOUNDS)}/" in f[0] for f in files)
    assert rl.read_by_key(stored, "k7", BOUNDS).count() == 15


def test_tails(log):
    last = {}
    for s, b, i in ids(log):
        last[s] = (b, i)
    assert {r["shard_id"]: (r["batch_id"], r["batch_index"]) for r in rl.tail_ids(log).collect()} == last


def test_append_results_share_the_fate_of_the_batch(spark, log):
    failed = spark.createDataFrame([(1, 2, "boom")], "shard_id bigint, batch_id bigint, error string")
    done = rl.append_results(log, failed).where("error is not null").collect()
    assert {(r["shard_id"], r["batch_id"], r["error"]) for r in done} == {(1, 2, "boom")} and len(done) == 7


def test_id_text_round_trip(spark, log):
    rows = log.select("*", parse_record_id(record_id_text()).alias("p")).collect()
    assert all((r["p"]["shard_id"], r["p"]["batch_id"], r["p"]["batch_index"]) == (r["shard_id"], r["batch_id"], r["batch_index"]) for r in rows)


@pytest.mark.parametrize("text", ["", "1-2", "1-2-3-4", "a-1-2", "1--2", "-1-2-3", " 1-2-3"])
def test_malformed_ids(spark, text):
    good, bad = parse_ids(spark.createDataFrame([(text,)], "rid string"))
    assert good.count() == 0 and bad.count() == 1


def test_trim_stream_takes_the_offset_too(one):
    kept = trim_stream(one, Offset.record(3, 4))
    assert ids(kept)[0] == (1, 3, 5)
    assert ids(trim_stream(kept, Offset.record(3, 4))) == ids(kept)
    assert trim_stream(one, Offset.earliest()).count() == 100 and trim_stream(one, Offset.latest()).count() == 0


def test_trim_shard_leaves_other_shards(log):
    before, kept = ids(log), ids(trim_shard(log, 2, Offset.record(2, 6)))
    assert [r for r in kept if r[0] != 2] == [r for r in before if r[0] != 2]
    assert [r for r in kept if r[0] == 2] == [r for r in before if r[0] == 2 and r[1:] > (2, 6)]


def test_trim_points_take_the_oldest_real_id(spark):
    texts = ["1-5-0", "1-2-9", "1-2-10", "1-0-0", "2-0-0", "3-7-1"]
    good, _ = parse_ids(spark.createDataFrame([(t,) for t in texts], "rid string"))
    assert {r["shard_id"]: r["rid"] for r in trim_points(good).collect()} == {1: "1-2-9", 2: "2-0-0", 3: "3-7-1"}


def test_trim_shards_keeps_the_point_and_shards_without_one(spark, log):
    good, _ = parse_ids(spark.createDataFrame([("1-3-2",), ("2-4-0",), ("2-2-1",)], "rid string"))
    points = {1: (3, 2), 2: (2, 1)}
    kept = trim_shards(log, trim_points(good))
    assert ids(kept) == [r for r in ids(log) if r[0] not in points or r[1:] >= points[r[0]]]
    assert ids(trim_shards(kept, trim_points(good))) == ids(kept)


def test_backlog(log):
    now = T0 + timedelta(seconds=299)
    assert keep_backlog(log, {"s": 0}, now).count() == 0
    assert keep_backlog(log, {"s": 10_000}, now).count() == 300
    assert keep_backlog(log, {"other": 1}, now).count() == 300
    kept = keep_backlog(log, {"s": 100}, now)
    assert kept.count() > 0 and kept.agg(F.min("publish_time")).first()[0] >= now - timedelta(seconds=100)
    assert log.where(F.col("publish_time") >= F.lit("2024-01-01 00:03:19").cast("timestamp_ntz")).count() == kept.count()


def test_reconcile_is_a_multiset_comparison(spark):
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "id bigint")
    got = reconcile(df([1, 2, 3, 3, 4]), df([2, 2, 3, 4, 5, 5]), ["id"]).collect()
    assert {(r["id"], r["status"]) for r in got} == {(1, "missing"), (2, "duplicate"), (3, "missing"), (5, "extra")}
    assert reconcile(df([1, 1, 2]), df([2, 1, 1]), ["id"]).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_export_keeps_bytes_and_microseconds(spark, fmt):
    rows = spark.createDataFrame(
        [("a", bytearray(b"\x00\xff,\"\n"), datetime(2024, 1, 1, 0, 0, 0, 123456)), ("b", bytearray(b"x"), datetime(2024, 1, 2))],
        "key string, payload binary, at timestamp_ntz",
    )
    path = scratch_path(spark, fmt)
    export_records(rows, path, fmt)
    back = import_records(spark, path, rows.schema, fmt)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_export_rejects_unknown_formats(one):
    with pytest.raises(ValueError):
        export_records(one, "/nowhere", "xlsx")


@pytest.mark.parametrize("bad", [{"replicas": 0}, {"shard_count": 0}, {"backlog_seconds": -1}])
def test_rejected_stream_options(bad):
    check_stream(2, 3, 1000)
    with pytest.raises(ValueError):
        check_stream(**bad)


@pytest.mark.parametrize("bad", [{"ack_timeout_s": 0}, {"max_unacked": 0}])
def test_rejected_subscription_options(bad):
    check_subscription(100, 1000)
    with pytest.raises(ValueError):
        check_subscription(**bad)


@pytest.mark.parametrize("rule", [Rule(count=7), Rule(count=9, n_bytes=40)])
def test_appends_go_on_from_the_tails(spark, rule):
    rows = spark.range(200).select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("k"), F.col("id") % 20).alias("key"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ts"),
        (F.col("id") % 11).alias("n_bytes"),
    )
    bounds, path = shard_bounds(4)[1:], scratch_path(spark, "twice")
    first = append(rows.where("event_id < 90"), path, bounds, rule)
    seen = {r["event_id"]: (r["rid"], r["error"]) for r in first.collect()}
    log = spark.read.parquet(path)
    tails = {r["shard_id"]: r["batch_id"] for r in rl.tail_ids(log).collect()}
    later = append(rows.where("event_id >= 90"), path, bounds, rule).collect()
    assert len(seen) == 90 and len(later) == 110
    assert all((rid is None) == (error == "no shard for key") for rid, error in seen.values())
    got = [tuple(map(int, r["rid"].split("-"))) for r in later if r["rid"]]
    for shard, tail in tails.items():
        mine = sorted(g[1:] for g in got if g[0] == shard)
        assert mine[0] == (tail + 1, 0) and {b for b, _ in mine} == set(range(tail + 1, mine[-1][0] + 1))
    stored = [r["event_id"] for r in spark.read.schema(log.schema).parquet(path).collect()]
    assert len(stored) == len(set(stored)) == sum(1 for rid, _ in seen.values() if rid) + len(got)


def test_trims_keep_records_without_a_time_and_need_an_offset(spark):
    log = spark.createDataFrame([(1, 1, T0), (1, 2, None)], "shard_id bigint, batch_id bigint, publish_time timestamp_ntz")
    log = log.withColumn("batch_index", F.lit(0))
    assert [r["batch_id"] for r in trim_stream(log, Offset.timestamp(T0)).collect()] == [2]
    for trim in (lambda o: trim_stream(log, o), lambda o: trim_shard(log, 1, o)):
        with pytest.raises(ValueError, match="trim needs an offset"):
            trim(Offset.empty())


def test_ids_of_any_size_that_fits(spark):
    texts = ["1234567890123456789-5-0", "1-2-2000000000", "9223372036854775808-1-1", "1-1-2147483648", "1-1"]
    good, bad = parse_ids(spark.createDataFrame([(t,) for t in texts], "rid string"))
    assert [(r["shard_id"], r["batch_id"], r["batch_index"]) for r in good.collect()] == [(1234567890123456789, 5, 0), (1, 2, 2000000000)]
    assert sorted(r["rid"] for r in bad.collect()) == sorted(texts[2:])
