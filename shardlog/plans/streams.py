"""Queries that run a stream to its end and read what it left behind."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shardlog.functions.offsets import from_predicate
from shardlog.functions.shards import assign_shards
from shardlog.model import Offset
from shardlog.operators.batching import Rule
from shardlog.operators.packing import pack_batches
from shardlog.operators.subscriptions import unacked
from shardlog.plans.registry import query
from shardlog.plans.relations import ACK_TIMEOUT_S, NUMBERED_SQL, REC_SQL, SHARDS5, SUB_SQL, acks, deliveries, log, log_path, records, rid, table
from shardlog.plans.writing import BYTES_RULE, BYTES_SQL
from shardlog.session import scratch_path, store
from shardlog.streaming.fetch import fetch_available, read_fetched
from shardlog.streaming.ingest import batcher, read_batched, run_available, table_stream
from shardlog.streaming.timeouts import timed_out
from shardlog.streaming.views import daily_totals, keep_view, read_view, stream_as_select

_DAILY_SQL = """SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n, sum(strlen(props))::BIGINT AS bytes
FROM events GROUP BY 1, 2"""


def _events(spark, sf):
    return table_stream(spark, f"{sf}/events.parquet*", table(spark, sf, "events").schema)


def _log_stream(spark, sf):
    return table_stream(spark, log_path(spark, sf), log(spark, sf).schema)


def _daily_view(spark, sf):
    out = scratch_path(spark, "view")
    sized = _events(spark, sf).withColumn("n_bytes", F.octet_length("props").cast("bigint"))
    schema = keep_view(daily_totals(sized, "ts", ["event_type"], "n_bytes"), f"{out}/changes", f"{out}/checkpoint", ["day", "event_type"], 10)
    return read_view(spark, f"{out}/changes", schema, ["day", "event_type"])


@query("continuous_view", _DAILY_SQL)
def _(spark, sf):
    """ST6: a view of daily totals kept up to date by a stream."""
    return _daily_view(spark, sf)


@query("view_query", f"SELECT event_type, sum(n)::BIGINT AS n, max(bytes)::BIGINT AS top_bytes FROM ({_DAILY_SQL}) WHERE day >= DATE '2024-01-10' GROUP BY 1")
def _(spark, sf):
    """ST8: SQL over the continuous view."""
    _daily_view(spark, sf).createOrReplaceTempView("shardlog_daily_view")
    return spark.sql(
        "SELECT event_type, sum(n) AS n, max(bytes) AS top_bytes FROM shardlog_daily_view "
        "WHERE day >= DATE'2024-01-10' GROUP BY event_type"
    )


@query("stream_as_select", "SELECT event_id, CAST(user_id AS VARCHAR) AS key, ts, strlen(props)::BIGINT AS n_bytes FROM events WHERE event_type = 'error'")
def _(spark, sf):
    """ST7: a derived stream of one event type."""
    out = scratch_path(spark, "derived")
    derived = _events(spark, sf).where("event_type = 'error'").select(
        "event_id", F.col("user_id").cast("string").alias("key"), "ts", F.octet_length("props").cast("bigint").alias("n_bytes")
    )
    stream_as_select(derived, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(derived.schema).parquet(f"{out}/rows")


@query("tail_stream", f"{NUMBERED_SQL} SELECT rid, event_id FROM numbered WHERE shard_id = 4")
def _(spark, sf):
    """One shard followed from its start."""
    out = scratch_path(spark, "tail")
    rows = _log_stream(spark, sf).where("shard_id = 4").select(rid(), "event_id")
    stream_as_select(rows, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


@query(
    "sub_fetch_unacked",
    f"""{SUB_SQL} SELECT rid FROM deliveries JOIN (SELECT rid, publish_time FROM numbered) USING (rid)
    WHERE publish_time >= TIMESTAMP '2024-01-12' AND rid NOT IN (SELECT rid FROM acks)""",
)
def _(spark, sf):
    """Records fetched by a subscription from a time on, less those acked."""
    out = scratch_path(spark, "fetch")
    rows = _log_stream(spark, sf).where(from_predicate(Offset.timestamp(datetime(2024, 1, 12)))).select(
        F.lit("s1").alias("sub_id"), "shard_id", "batch_id", "batch_index", F.col("ts").alias("delivered_at")
    )
    stream_as_select(rows, f"{out}/rows", f"{out}/checkpoint")
    return unacked(spark.read.schema(rows.schema).parquet(f"{out}/rows"), acks(spark, sf)).select(rid())


ARRIVALS = 3


def _arrivals(spark, rows, number):
    """The folder to which parts of ``rows``, counted by the column ``number``, come one
    after the other: yielded after each, so that each is a micro-batch at least."""
    path = scratch_path(spark, "arrivals")
    for i in range(ARRIVALS):
        rows.where(number == i).write.mode("append").parquet(path)
        yield path


def _batched(spark, sf, rule, which="true", flush=True):
    out = scratch_path(spark, "ingest")
    events = table(spark, sf, "events")
    cuts = events.agg(F.percentile_approx("ts", [i / ARRIVALS for i in range(1, ARRIVALS)])).first()[0]
    number = sum((F.col("ts") > F.lit(c)).cast("int") for c in cuts)
    for path in _arrivals(spark, events, number):
        rows = assign_shards(records(spark, sf, table_stream(spark, path, events.schema)), SHARDS5).where(which)
        run_available(
            rows.writeStream.foreachBatch(batcher(out, ["shard_id"], "ts", ["event_id"], "n_bytes", rule)), f"{out}/checkpoint"
        )
    return read_batched(spark, out, rows.schema, ["shard_id"], flush)


@query("stream_ingest", f"{NUMBERED_SQL} SELECT event_id, rid, n_bytes, publish_time FROM numbered")
def _(spark, sf):
    """ST2: a stream of events into a log of batches of 100."""
    return _batched(spark, sf, Rule(count=100)).select("event_id", rid(), "n_bytes", "publish_time")


@query("stream_batcher", BYTES_SQL)
def _(spark, sf):
    """ST3: batches by count or bytes that stay open between micro-batches."""
    return _batched(spark, sf, BYTES_RULE).select("event_id", "shard_id", "batch_id", "batch_index")


_SLOT_S = 21_600
# Nothing comes to shard 2 any more after some days.
_QUIET = "NOT (shard_id = 2 AND ts >= TIMESTAMP_NTZ '2024-01-19 08:00:00')"


@query(
    "stream_timer",
    f"""{REC_SQL},
    timed AS (SELECT event_id, shard_id, epoch_us(ts) AS us, min(epoch_us(ts)) OVER (PARTITION BY shard_id) AS root
      FROM rec WHERE {_QUIET.replace('TIMESTAMP_NTZ', 'TIMESTAMP')}),
    slots AS (SELECT *, (us - root) // {_SLOT_S * 1_000_000} AS slot FROM timed)
    SELECT event_id, shard_id, dense_rank() OVER (PARTITION BY shard_id ORDER BY slot) AS batch_id FROM slots
    WHERE root + (slot + 1) * {_SLOT_S * 1_000_000} <= (SELECT max(us) FROM timed)""",
)
def _(spark, sf):
    """W4, ST3: batches closed by the timer alone, each as soon as the clock of all
    shards has passed its time, also the last one of a shard that went quiet."""
    rule = Rule(count=1_000_000, timeout_us=_SLOT_S * 1_000_000)
    return _batched(spark, sf, rule, _QUIET, flush=False).select("event_id", "shard_id", "batch_id")


# A tenth of shard 2's batches claims a record too many.
_FETCH_SQL = f"""{NUMBERED_SQL},
batch AS (
  SELECT shard_id, batch_id, shard_id = 2 AND batch_id % 10 = 0 AS bad,
         (batch_id - 1) * {ARRIVALS} // (SELECT max(batch_id) FROM numbered) AS arrival
  FROM numbered GROUP BY shard_id, batch_id),
good AS (SELECT * FROM numbered JOIN batch USING (shard_id, batch_id) WHERE NOT bad),
stop AS (SELECT coalesce(min(arrival), {ARRIVALS}) AS arrival FROM batch WHERE bad),
first AS (SELECT shard_id, min(batch_id) AS first FROM batch WHERE bad GROUP BY shard_id)"""


def _fetched(spark, sf, on_error):
    packed = store(pack_batches(log(spark, sf), ["shard_id"], "zstd"), "packed")
    bad = (F.col("shard_id") == 2) & (F.col("batch_id") % 10 == 0)
    sent = packed.withColumn("batch_size", F.col("batch_size") + F.when(bad, 1).otherwise(0))
    top = packed.agg(F.max("batch_id")).first()[0]
    out = scratch_path(spark, "packed-fetch")
    for path in _arrivals(spark, sent, F.floor((F.col("batch_id") - 1) * ARRIVALS / top)):
        stream = table_stream(spark, path, sent.schema)
        if not fetch_available(stream, out, ["shard_id"], on_error):
            break
    return read_fetched(stream, out, ["shard_id"]).select(rid(), "key", F.octet_length("payload").cast("bigint").alias("n_bytes"))


@query("packed_fetch_skip", f"{_FETCH_SQL} SELECT rid, key, n_bytes FROM good")
def _(spark, sf):
    """Packed batches opened as they come; bad ones are set aside."""
    return _fetched(spark, sf, "skip")


@query(
    "packed_fetch_stop",
    f"""{_FETCH_SQL} SELECT rid, key, n_bytes FROM good LEFT JOIN first USING (shard_id)
    WHERE arrival <= (SELECT arrival FROM stop) AND (first IS NULL OR batch_id < first)""",
)
def _(spark, sf):
    """The same, ended by the first bad batch."""
    return _fetched(spark, sf, "stop")


# Every fifth ack arrives up to an hour after it was given.
_LATE_S = 3_600


@query(
    "stream_ack_timeout",
    f"""{SUB_SQL},
    passed AS (SELECT least((SELECT max(delivered_at) FROM deliveries), (SELECT max(acked_at) FROM acks)) - to_seconds({_LATE_S}) AS t)
    SELECT rid, delivered_at, delivered_at + to_seconds({ACK_TIMEOUT_S}) AS due FROM deliveries d, passed
    WHERE delivered_at + to_seconds({ACK_TIMEOUT_S}) < t AND NOT EXISTS (
      SELECT 1 FROM acks a WHERE a.rid = d.rid AND acked_at BETWEEN delivered_at - to_seconds({ACK_TIMEOUT_S}) AND delivered_at + to_seconds({ACK_TIMEOUT_S}))""",
)
def _(spark, sf):
    """J5 on running streams: records whose ack did not come in time, over three arrivals
    with late acks. What the watermarks have not passed is still waited for."""
    out = scratch_path(spark, "ack-timeout")
    sent, heard = deliveries(spark, sf), acks(spark, sf, "event_id")
    cuts = [F.lit(c) for c in sent.agg(F.percentile_approx("delivered_at", [i / ARRIVALS for i in range(1, ARRIVALS)])).first()[0]]
    number = lambda at: sum((at > c).cast("int") for c in cuts)
    arrived = F.col("acked_at") + F.make_dt_interval(secs=F.when(F.col("event_id") % 5 == 0, _LATE_S).otherwise(0).cast("decimal(18,6)"))
    sends = _arrivals(spark, sent, number(F.col("delivered_at")))
    for path, ack_path in zip(sends, _arrivals(spark, heard, number(arrived))):
        waiting = timed_out(
            table_stream(spark, path, sent.schema), table_stream(spark, ack_path, heard.schema), ACK_TIMEOUT_S, f"{_LATE_S} seconds"
        ).select(rid(), "delivered_at", "due")
        stream_as_select(waiting, f"{out}/rows", f"{out}/checkpoint")
    return spark.read.schema(waiting.schema).parquet(f"{out}/rows")
