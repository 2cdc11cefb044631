"""Queries on subscriptions and statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shardlog.model import ERROR_UNKNOWN_STAT
from shardlog.operators.stats import STREAM_STATS, rates, requested_stats, stream_counters, sub_counters
from shardlog.operators.subscriptions import (
    ack_latency, batch_acks, commit_frontier, consumers_of, inflight_peaks, last_attempts, number_attempts, redeliveries,
    start_position, unacked,
)
from shardlog.plans.registry import query
from shardlog.plans.relations import (
    ACK_TIMEOUT_S, STREAMS_SQL, SUB_SQL, acks, as_of, deliveries, log, rid, stream_directory, stream_log,
)
from shardlog.plans.writing import fold_sql

INTERVALS = [60, 3_600, 86_400, 604_800]
RESENDS_SQL = f"""resends AS (
  SELECT *, delivered_at + to_seconds({ACK_TIMEOUT_S}) AS first_resend, delivered_at + to_seconds(n_resends * {ACK_TIMEOUT_S}) AS last_resend FROM (
    SELECT d.*, (least(epoch_us((SELECT t FROM now)), coalesce(epoch_us(acked_at) - 1, epoch_us((SELECT t FROM now)))) - epoch_us(delivered_at))
                // {ACK_TIMEOUT_S * 1_000_000} AS n_resends
    FROM deliveries d LEFT JOIN (SELECT rid, min(acked_at) AS acked_at FROM acks GROUP BY rid) a USING (rid))
  WHERE n_resends > 0)"""


@query("list_consumers", f"{SUB_SQL} SELECT consumer_name AS consumer, count(DISTINCT (shard_id, batch_id)) AS n_batches FROM deliveries GROUP BY 1")
def _(spark, sf):
    """Consumers of the subscription."""
    return consumers_of(deliveries(spark, sf)).select(F.col("consumer_name").alias("consumer"), "n_batches")


@query(
    "sub_start_position",
    f"""{SUB_SQL}, tails AS (
      SELECT shard_id, max(batch_id * 1000 + batch_index) AS t FROM numbered WHERE publish_time <= TIMESTAMP '2024-01-20' GROUP BY shard_id)
    SELECT rid FROM numbered LEFT JOIN tails USING (shard_id) WHERE t IS NULL OR batch_id * 1000 + batch_index > t""",
)
def _(spark, sf):
    """ST1: a subscription from latest, made on a given day."""
    return start_position(log(spark, sf), "latest", datetime(2024, 1, 20)).select(rid())


UNACKED_SQL = f"{SUB_SQL} SELECT rid FROM deliveries d WHERE NOT EXISTS (SELECT 1 FROM acks a WHERE a.rid = d.rid)"


@query("sub_unacked", UNACKED_SQL)
def _(spark, sf):
    """Delivered and not acked."""
    return unacked(deliveries(spark, sf), acks(spark, sf)).select(rid())


def _resends(spark, sf):
    return redeliveries(deliveries(spark, sf), acks(spark, sf), ACK_TIMEOUT_S, as_of(spark, sf))


@query("sub_redelivery", f"{SUB_SQL}, {RESENDS_SQL} SELECT rid, n_resends::BIGINT AS n_resends, first_resend, last_resend FROM resends")
def _(spark, sf):
    """How often records were sent again after the ack timeout, first and last."""
    return _resends(spark, sf).select(rid(), "n_resends", "first_resend", "last_resend")


def _attempts(sent, acked, now):
    numbered = number_attempts(sent)
    return numbered.unionByName(last_attempts(redeliveries(numbered, acked, ACK_TIMEOUT_S, now)).select(*numbered.columns))


@query(
    "sub_attempts",
    f"""{SUB_SQL}, {RESENDS_SQL},
    sent AS (SELECT rid, delivered_at, row_number() OVER (PARTITION BY rid ORDER BY delivered_at) AS attempt FROM deliveries)
    SELECT rid, attempt::INTEGER AS attempt, delivered_at FROM sent
    UNION ALL SELECT rid, (attempt + n_resends)::INTEGER, last_resend FROM resends JOIN sent USING (rid, delivered_at)""",
)
def _(spark, sf):
    """The deliveries of each record, numbered, and its last send with the number
    that all resends before it leave to it."""
    return _attempts(deliveries(spark, sf), acks(spark, sf), as_of(spark, sf)).select(rid(), "attempt", "delivered_at")


# Every thirteenth record is sent again 100 seconds later, and every third ack comes twice.
# The clock stops on January 25, with sends and acks behind it.
REPEATED_AS_OF = datetime(2024, 1, 25)
REPEATED_SQL = f"""{SUB_SQL},
sends AS (
  SELECT * FROM deliveries
  UNION ALL SELECT sub_id, consumer_name, shard_id, batch_id, batch_index, rid, event_id, n_bytes, delivered_at + to_seconds(100), failed
  FROM deliveries WHERE event_id % 13 = 0),
heard AS (
  SELECT a.* FROM acks a UNION ALL
  SELECT a.sub_id, a.shard_id, a.batch_id, a.batch_index, a.rid, a.acked_at + to_seconds(30) FROM acks a JOIN deliveries d USING (rid) WHERE event_id % 3 = 0),
clock AS (SELECT TIMESTAMP '{REPEATED_AS_OF}' AS t),
seen AS (SELECT sends.*, row_number() OVER (PARTITION BY rid ORDER BY delivered_at) AS attempt, count(*) OVER (PARTITION BY rid) AS n_sends
  FROM sends, clock WHERE delivered_at <= t),
again AS (
  SELECT *, delivered_at + to_seconds({ACK_TIMEOUT_S}) AS first_resend, delivered_at + to_seconds(n_resends * {ACK_TIMEOUT_S}) AS last_resend FROM (
    SELECT s.*, (least(epoch_us(t), coalesce(epoch_us(acked_at) - 1, epoch_us(t))) - epoch_us(delivered_at)) // {ACK_TIMEOUT_S * 1_000_000} AS n_resends
    FROM seen s LEFT JOIN (SELECT rid, min(acked_at) AS acked_at FROM heard GROUP BY rid) USING (rid), clock
    WHERE attempt = n_sends)
  WHERE n_resends > 0)"""


def _repeated(spark, sf):
    """Sends up to the clock, and all acks."""
    sent = deliveries(spark, sf)
    later = F.col("delivered_at") + F.make_dt_interval(secs=F.lit(100).cast("decimal(18,6)"))
    sent = sent.unionByName(sent.where("event_id % 13 = 0").withColumn("delivered_at", later))
    heard = acks(spark, sf, "event_id")
    late = F.col("acked_at") + F.make_dt_interval(secs=F.lit(30).cast("decimal(18,6)"))
    heard = heard.unionByName(heard.where("event_id % 3 = 0").withColumn("acked_at", late)).drop("event_id")
    return sent.where(F.col("delivered_at") <= F.lit(str(REPEATED_AS_OF)).cast("timestamp_ntz")), heard


@query("sub_redelivery_repeated", f"{REPEATED_SQL} SELECT rid, n_resends::BIGINT AS n_resends, first_resend, last_resend FROM again")
def _(spark, sf):
    """J5 where records were sent more than once: the timer runs from the last send."""
    sent, heard = _repeated(spark, sf)
    return redeliveries(sent, heard, ACK_TIMEOUT_S, REPEATED_AS_OF).select(rid(), "n_resends", "first_resend", "last_resend")


@query(
    "sub_attempts_repeated",
    f"""{REPEATED_SQL} SELECT rid, attempt::INTEGER AS attempt, delivered_at FROM seen
    UNION ALL SELECT rid, (attempt + n_resends)::INTEGER, last_resend FROM again""",
)
def _(spark, sf):
    """W7 where records were sent more than once: one last send each."""
    sent, heard = _repeated(spark, sf)
    return _attempts(sent, heard, REPEATED_AS_OF).select(rid(), "attempt", "delivered_at")


@query(
    "sub_ack_latency",
    f"""{SUB_SQL}
    SELECT consumer_name AS consumer, count(*) FILTER (acked_at <= delivered_at + to_seconds({ACK_TIMEOUT_S})) AS n_on_time,
           count(*) FILTER (acked_at > delivered_at + to_seconds({ACK_TIMEOUT_S})) AS n_late,
           count(*) FILTER (acked_at IS NULL) AS n_missing,
           round(avg((epoch_us(acked_at) - epoch_us(delivered_at)) / 1000000), 3) AS avg_s
    FROM deliveries LEFT JOIN (SELECT rid, acked_at FROM acks) USING (rid) GROUP BY 1""",
)
def _(spark, sf):
    """Acks in time, late and missing of each consumer."""
    lat = ack_latency(deliveries(spark, sf), acks(spark, sf), ACK_TIMEOUT_S)
    return lat.select(F.col("consumer_name").alias("consumer"), "n_on_time", "n_late", "n_missing", F.round("avg_s", 3).alias("avg_s"))


@query(
    "sub_inflight",
    f"""{SUB_SQL},
    steps AS (SELECT delivered_at AS t, 1 AS step, rid FROM deliveries UNION ALL SELECT min(acked_at), -1, rid FROM acks GROUP BY rid),
    run AS (SELECT t, sum(step) OVER (ORDER BY t, step, rid ROWS UNBOUNDED PRECEDING) AS level FROM steps)
    SELECT date_trunc('minute', t)::TIMESTAMP AS minute, max(level)::BIGINT AS max_inflight FROM run GROUP BY 1""",
)
def _(spark, sf):
    """Most unacked records at once, by minute."""
    return inflight_peaks(deliveries(spark, sf), acks(spark, sf)).select("minute", "max_inflight")


@query(
    "sub_commit_frontier",
    f"""{SUB_SQL}
    SELECT shard_id, coalesce(min(batch_id) FILTER (a.rid IS NULL) - 1, max(batch_id)) AS committed_batch
    FROM deliveries d LEFT JOIN (SELECT DISTINCT rid FROM acks) a USING (rid) GROUP BY shard_id""",
)
def _(spark, sf):
    """Per shard, the last batch below which all is acked."""
    return commit_frontier(deliveries(spark, sf), acks(spark, sf)).select("shard_id", "committed_batch")


_ACK_SOURCE = "(SELECT sub_id, rid, shard_id, batch_id AS b, batch_index AS i, 0::BIGINT AS n_bytes, epoch_us(acked_at) AS us FROM acks)"
ACK_FOLD = fold_sql(_ACK_SOURCE, "us, shard_id, b, i", 100, None, 5_000_000, "seq.rid", "sub_id")


@query("ack_batches", f"{SUB_SQL}, {ACK_FOLD} SELECT rid, batch_id AS request_id, batch_index AS request_index FROM cut")
def _(spark, sf):
    """Acks grouped into requests of 100 or 5 seconds."""
    return batch_acks(acks(spark, sf)).records.select(rid(), "request_id", "request_index")


ACK_HOUR_FOLD = fold_sql(_ACK_SOURCE, "us, shard_id, b, i", 100, None, 3_600_000_000, "seq.rid", "sub_id")


@query("ack_batches_hourly", f"{SUB_SQL}, {ACK_HOUR_FOLD} SELECT rid, batch_id AS request_id, batch_index AS request_index FROM cut")
def _(spark, sf):
    """W6 with an hourly timer, so that requests hold many acks."""
    return batch_acks(acks(spark, sf), 100, 3_600).records.select(rid(), "request_id", "request_index")


# --- statistics -------------------------------------------------------------

def _stream_counters(spark, sf):
    """Appends fail for batches ending in 7; each stored record is read once."""
    rows = stream_log(spark, sf)
    error = F.when(F.col("batch_id") % 10 == 7, F.lit("append failed"))
    return stream_counters(rows.withColumn("error", error), rows.where(error.isNull()))


_COUNTERS = f"""{STREAMS_SQL},
c AS (
  SELECT stream_name, coalesce(sum(n_bytes) FILTER (batch_id % 10 <> 7), 0)::BIGINT AS append_in_bytes,
         count(*) FILTER (batch_id % 10 <> 7) AS append_in_records,
         count(DISTINCT (shard_id, batch_id)) AS append_total,
         count(DISTINCT (shard_id, batch_id)) FILTER (batch_id % 10 = 7) AS append_failed,
         coalesce(sum(n_bytes) FILTER (batch_id % 10 <> 7), 0)::BIGINT AS read_in_bytes,
         count(DISTINCT (shard_id, batch_id)) FILTER (batch_id % 10 <> 7) AS read_in_batches
  FROM numbered GROUP BY stream_name),
counters AS ({' UNION ALL '.join(f"SELECT '{s}' AS stat, stream_name AS entity, {s} AS value FROM c" for s in STREAM_STATS)})"""


@query("stream_counters", f"{_COUNTERS} SELECT stat, entity, value FROM counters")
def _(spark, sf):
    """A4: six counters of every stream."""
    return _stream_counters(spark, sf)


@query(
    "stats_with_errors",
    f"""{_COUNTERS}, wanted(stat) AS (VALUES ('append_in_bytes'), ('read_in_batches'), ('append_in_colours'))
    SELECT stat, entity, value, CASE WHEN value IS NULL THEN '{ERROR_UNKNOWN_STAT}' END AS error FROM wanted LEFT JOIN counters USING (stat)""",
)
def _(spark, sf):
    """Values of the stats asked for, an error for the unknown one."""
    return requested_stats(_stream_counters(spark, sf), ["append_in_bytes", "read_in_batches", "append_in_colours"])


@query(
    "sub_counters",
    f"""{SUB_SQL}, {RESENDS_SQL}, {ACK_FOLD},
    v AS (
      SELECT 'send_out_bytes' AS stat, sum(n_bytes) FILTER (NOT failed) AS value FROM deliveries
      UNION ALL SELECT 'send_out_records', count(*) FILTER (NOT failed) FROM deliveries
      UNION ALL SELECT 'send_out_records_failed', count(*) FILTER (failed) FROM deliveries
      UNION ALL SELECT 'resend_records', sum(n_resends) FILTER (NOT failed) FROM resends
      UNION ALL SELECT 'resend_records_failed', sum(n_resends) FILTER (failed) FROM resends
      UNION ALL SELECT 'received_acks', count(*) FROM acks
      UNION ALL SELECT 'request_messages', max(batch_id) FROM cut
      UNION ALL SELECT 'response_messages', count(DISTINCT (shard_id, batch_id)) FROM deliveries
      UNION ALL SELECT 'check_list_size', count(*) FROM deliveries WHERE rid NOT IN (SELECT rid FROM acks))
    SELECT stat, 's1' AS entity, CAST(value AS BIGINT) AS value FROM v""",
)
def _(spark, sf):
    """A5: nine counters of the subscription."""
    return sub_counters(deliveries(spark, sf), _resends(spark, sf), acks(spark, sf))


def _rates_sql(amount: str, where: str, rows: str = "numbered") -> str:
    return f"""{STREAMS_SQL}, i(ord, interval_s) AS (VALUES {', '.join(f'({n}, {s}::BIGINT)' for n, s in enumerate(INTERVALS))}),
    now AS (SELECT max(ts) AS t FROM events)
    SELECT stream_name, CAST(ord AS INTEGER) AS ord, interval_s,
           round(coalesce(sum({amount}) FILTER (ts > t - to_seconds(interval_s) AND ts <= t), 0) / interval_s, 9) AS rate
    FROM {rows}, i, now {where} GROUP BY stream_name, ord, interval_s"""


@query("rate_one_stream", _rates_sql("n_bytes", "WHERE stream_name = 'click'"))
def _(spark, sf):
    """Bytes per second of one stream over four intervals."""
    out = rates(stream_log(spark, sf), "append_in_bytes", INTERVALS, as_of(spark, sf), "click", stream_directory(spark, sf))
    return out.withColumn("rate", F.round("rate", 9))


@query("rate_all_streams", _rates_sql("1", ""))
def _(spark, sf):
    """A10: records per second of every stream over four intervals."""
    out = rates(stream_log(spark, sf), "append_in_records", INTERVALS, as_of(spark, sf), directory=stream_directory(spark, sf))
    return out.withColumn("rate", F.round("rate", 9))


@query("rate_read_batches", _rates_sql("1", "", "(SELECT stream_name, min(ts) AS ts FROM numbered GROUP BY stream_name, shard_id, batch_id)"))
def _(spark, sf):
    """A10: batches read per second of every stream, each when its first record was."""
    out = rates(stream_log(spark, sf), "read_in_batches", INTERVALS, as_of(spark, sf), directory=stream_directory(spark, sf))
    return out.withColumn("rate", F.round("rate", 9))
