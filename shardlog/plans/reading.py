"""Queries on reads and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shardlog.functions.shards import shard_bounds, shards_frame
from shardlog.model import Offset
from shardlog.operators.batching import batch_by_count
from shardlog.operators.reconcile import reconcile
from shardlog.operators.retention import keep_backlog_files, parse_ids, trim_points, trim_shard, trim_shards, trim_stream
from shardlog.plans.registry import query
from shardlog.plans.relations import (
    NUMBERED_SQL, SHARDS5, STREAMS_SQL, as_of, log, log_directory, records, rid, stream_directory, stream_log, stream_log_path,
)
from shardlog.functions.ids import parse_record_id, record_id_text
from shardlog.functions.shards import assign_shards
from shardlog.sources.directory import tails
from shardlog.sources.record_log import (
    first_batches, first_records_per_shard, read_by_key, read_shard, read_shard_batches, read_single_shard, read_stream,
)

BACKLOG = {"click": 86_400, "view": 604_800, "error": 0, "purchase": 1_209_600, "signup": 2_592_000}


@query(
    "read_stream_range",
    f"""{NUMBERED_SQL} SELECT rid, event_id FROM numbered
    WHERE publish_time >= TIMESTAMP '2024-01-08' AND publish_time <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def _(spark, sf):
    """All shards between two times."""
    return read_stream(
        log(spark, sf), None, Offset.timestamp(datetime(2024, 1, 8)), Offset.timestamp(datetime(2024, 1, 20, 12))
    ).select(rid(), "event_id")


@query("read_stream_all", f"{STREAMS_SQL} SELECT stream_name, rid, event_id FROM numbered WHERE stream_name = 'view'")
def _(spark, sf):
    """One stream from its start to its end, without a limit."""
    return read_stream(stream_log(spark, sf), "view", Offset.empty(), Offset.latest(), 0).select("stream_name", rid(), "event_id")


@query("read_shard_limit", f"{NUMBERED_SQL} SELECT shard_id, rid, event_id FROM numbered WHERE (batch_id - 1) * 100 + batch_index < 30")
def _(spark, sf):
    """One read of every shard, 30 records each."""
    return first_records_per_shard(log(spark, sf), 30, directory=log_directory(spark, sf)).select("shard_id", rid(), "event_id")


@query(
    "read_shard_first",
    f"""{NUMBERED_SQL} SELECT rid, event_id FROM numbered WHERE shard_id = 3 AND (batch_id, batch_index) >= (2, 40)
    ORDER BY batch_id, batch_index LIMIT 10""",
)
def _(spark, sf):
    """Ten records of one shard from a record on."""
    return read_shard(log(spark, sf), 3, Offset.record(2, 40), max_records=10, directory=log_directory(spark, sf)).select(rid(), "event_id")


@query(
    "read_shard_range",
    f"""{NUMBERED_SQL} SELECT rid, event_id FROM numbered
    WHERE shard_id = 2 AND batch_id * 1000 + batch_index >= 3050 AND batch_id * 1000 + batch_index <= 9020""",
)
def _(spark, sf):
    """S3: one shard between two records."""
    return read_shard_batches(log(spark, sf), 2, Offset.record(3, 50), Offset.record(9, 20)).select(rid(), "event_id")


@query(
    "read_single_shard",
    """WITH o AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS n FROM events)
    SELECT concat_ws('-', 1, n // 100 + 1, n % 100) AS rid, event_id FROM o WHERE n >= 200""",
)
def _(spark, sf):
    """A stream of exactly one shard, from its third batch on."""
    one = shard_bounds(1)
    rows = assign_shards(records(spark, sf).select("event_id", "ts", "hash_key"), one)
    cut = batch_by_count(rows, ["shard_id"], ["ts", "event_id"], 100)
    return read_single_shard(cut, shards_frame(spark, one), Offset.record(3, 0)).select(rid(), "event_id")


@query("read_by_key", f"{NUMBERED_SQL} SELECT rid, event_id FROM numbered WHERE user_id = 8 ORDER BY batch_id, batch_index LIMIT 25")
def _(spark, sf):
    """The first 25 records of a key, from the files of its shard only."""
    return read_by_key(log(spark, sf), "8", SHARDS5, count=25).select(rid(), "event_id")


@query("read_by_key_all", f"{NUMBERED_SQL} SELECT rid, event_id FROM numbered WHERE user_id = 8 AND publish_time >= TIMESTAMP '2024-01-10'")
def _(spark, sf):
    """All records of a key from a time on."""
    return read_by_key(log(spark, sf), "8", SHARDS5, Offset.timestamp(datetime(2024, 1, 10))).select(rid(), "event_id")


@query("read_from_record", f"{NUMBERED_SQL} SELECT rid, event_id FROM numbered WHERE (batch_id, batch_index) >= (10, 25)")
def _(spark, sf):
    """From a record on, inclusive."""
    return read_stream(log(spark, sf), None, Offset.record(10, 25)).select(rid(), "event_id")


@query("read_from_timestamp", f"{NUMBERED_SQL} SELECT rid, event_id FROM numbered WHERE publish_time >= TIMESTAMP '2024-01-15'")
def _(spark, sf):
    """From a time on; batches stay whole."""
    return read_stream(log(spark, sf), None, Offset.timestamp(1_705_276_800_000)).select(rid(), "event_id")


@query(
    "read_max_batches",
    f"""{NUMBERED_SQL} SELECT rid, event_id FROM numbered WHERE (batch_id, shard_id) IN (
      SELECT (batch_id, shard_id) FROM numbered GROUP BY batch_id, shard_id ORDER BY batch_id, shard_id LIMIT 12)""",
)
def _(spark, sf):
    """The first twelve batches of a stream."""
    return first_batches(log(spark, sf), 12).select(rid(), "event_id")


@query(
    "tail_record_id",
    f"""{NUMBERED_SQL} SELECT shard_id, max(batch_id) AS batch_id, arg_max(batch_index, batch_id * 100 + batch_index) AS batch_index
    FROM numbered GROUP BY shard_id""",
)
def _(spark, sf):
    """The last id of every shard."""
    return tails(log_directory(spark, sf))


# --- retention --------------------------------------------------------------

def _kept(rows):
    return rows.groupBy("shard_id").agg(
        F.count("*").alias("rows_kept"), F.min(F.struct("batch_id", "batch_index")).alias("f")
    ).select("shard_id", "rows_kept", F.concat_ws("-", "shard_id", "f.batch_id", "f.batch_index").alias("first_id"))


_KEPT = "SELECT shard_id, count(*) AS rows_kept, arg_min(rid, batch_id * 100 + batch_index) AS first_id FROM"


@query("trim_stream_ts", f"{NUMBERED_SQL} {_KEPT} numbered WHERE publish_time > TIMESTAMP '2024-01-15' GROUP BY shard_id")
def _(spark, sf):
    """K7: a stream trimmed at a time."""
    return _kept(trim_stream(log(spark, sf), Offset.timestamp(datetime(2024, 1, 15))))


@query("trim_shard", f"{NUMBERED_SQL} {_KEPT} numbered WHERE shard_id <> 2 OR (batch_id, batch_index) > (5, 50) GROUP BY shard_id")
def _(spark, sf):
    """K8: one shard trimmed up to and including a record."""
    return _kept(trim_shard(log(spark, sf), 2, Offset.record(5, 50)))


def _point_texts(spark, sf):
    """Ids in text: every ninetieth record from some day on, plus 0-0 of all shards."""
    rows = log(spark, sf)
    chosen = rows.where((F.col("event_id") % 90 == 0) & (F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("shard_id") < 5))
    starts = shards_frame(spark, SHARDS5).select(F.concat_ws("-", "shard_id", F.lit(0), F.lit(0)).alias("rid"))
    return chosen.select(rid()).unionByName(starts)


_POINTS = f"""{NUMBERED_SQL},
texts AS (
  SELECT rid FROM numbered WHERE event_id % 90 = 0 AND ts >= TIMESTAMP '2024-01-10' AND shard_id < 5
  UNION ALL SELECT concat_ws('-', shard_id, 0, 0) FROM sh),
parsed AS (SELECT CAST(split_part(rid, '-', 1) AS BIGINT) AS shard_id, CAST(split_part(rid, '-', 2) AS BIGINT) AS b,
                  CAST(split_part(rid, '-', 3) AS BIGINT) AS i FROM texts),
points AS (
  SELECT shard_id, coalesce(min(b * 1000 + i) FILTER (b + i > 0), 0) AS p FROM parsed GROUP BY shard_id)"""


@query("trim_points", f"{_POINTS} SELECT shard_id, concat_ws('-', shard_id, p // 1000, p % 1000) AS rid FROM points")
def _(spark, sf):
    """K9, A3: the oldest id given for each shard."""
    good, _ = parse_ids(_point_texts(spark, sf))
    return trim_points(good).select("shard_id", "rid")


@query(
    "trim_shards",
    f"""{_POINTS} {_KEPT} (
      SELECT n.* FROM numbered n LEFT JOIN points USING (shard_id) WHERE p IS NULL OR batch_id * 1000 + batch_index >= p) GROUP BY shard_id""",
)
def _(spark, sf):
    """Every shard trimmed before its oldest given id."""
    good, _ = parse_ids(_point_texts(spark, sf))
    return _kept(trim_shards(log(spark, sf), trim_points(good)))


@query(
    "parse_record_ids",
    f"""{NUMBERED_SQL}
    SELECT CASE WHEN event_id % 50 = 0 THEN 'x' || rid ELSE rid END AS rid, event_id % 50 <> 0 AS valid,
           CASE WHEN event_id % 50 <> 0 THEN shard_id END AS shard_id, CASE WHEN event_id % 50 <> 0 THEN batch_id END AS batch_id,
           CASE WHEN event_id % 50 <> 0 THEN batch_index END AS batch_index
    FROM numbered""",
)
def _(spark, sf):
    """ids from text, malformed ones set aside."""
    texts = log(spark, sf).select(
        F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("x"), record_id_text())).otherwise(record_id_text()).alias("rid")
    )
    parsed = texts.select("rid", parse_record_id(F.col("rid")).alias("id"))
    return parsed.select("rid", F.col("id").isNotNull().alias("valid"), "id.*")


@query(
    "backlog_retention",
    f"""{STREAMS_SQL},
    backlog(stream_name, s) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in BACKLOG.items())})
    SELECT stream_name, shard_id, count(*) AS rows_kept, arg_min(rid, batch_id * 100 + batch_index) AS first_id
    FROM numbered JOIN backlog USING (stream_name)
    WHERE s > 0 AND publish_time >= (SELECT max(ts) FROM events) - to_seconds(s) GROUP BY stream_name, shard_id""",
)
def _(spark, sf):
    """Each stream keeps its own backlog; 0 keeps none."""
    path, schema = stream_log_path(spark, sf), stream_log(spark, sf).schema
    kept = keep_backlog_files(stream_directory(spark, sf), path, schema, BACKLOG, as_of(spark, sf))
    return kept.groupBy("stream_name", "shard_id").agg(
        F.count("*").alias("rows_kept"), F.min(F.struct("batch_id", "batch_index")).alias("f")
    ).select("stream_name", "shard_id", "rows_kept", F.concat_ws("-", "shard_id", "f.batch_id", "f.batch_index").alias("first_id"))


@query(
    "reconcile",
    f"""{NUMBERED_SQL},
    p AS (SELECT rid, count(*) AS np FROM numbered WHERE event_id % 11 <> 0 GROUP BY rid),
    c AS (SELECT rid, count(*) AS nc FROM (
      SELECT rid FROM numbered WHERE event_id % 13 <> 0 UNION ALL SELECT rid FROM numbered WHERE event_id % 101 = 0) GROUP BY rid),
    j AS (SELECT rid, coalesce(np, 0) AS np, coalesce(nc, 0) AS nc FROM p FULL JOIN c USING (rid))
    SELECT rid, CASE WHEN np = 0 THEN 'extra' WHEN nc < np THEN 'missing' ELSE 'duplicate' END AS status FROM j WHERE np <> nc""",
)
def _(spark, sf):
    """What was lost, made up or repeated between producing and consuming."""
    rows = log(spark, sf)
    produced = rows.where("event_id % 11 <> 0")
    consumed = rows.where("event_id % 13 <> 0").unionByName(rows.where("event_id % 101 = 0"))
    ids = ["shard_id", "batch_id", "batch_index"]
    return reconcile(produced.select(ids), consumed.select(ids), ids).select(rid(), "status")
