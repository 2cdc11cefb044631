"""Relations the queries share, as DataFrames and as SQL of the same meaning.

The ``events`` table is the record source: key = user, payload = props, order =
(ts, event_id). It is appended once per session to a log of five shards, in
batches of 100, and read from there, as one reads a log.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardlog.functions.ids import record_id_text
from shardlog.functions.shards import assign_shards, hash_key, shard_bounds
from shardlog.model import FLAG_JSON
from shardlog.operators.batching import batch_by_count, stamp_publish_time
from shardlog.session import scratch_path
from shardlog.sources.directory import SHARD_TYPE, read_directory, record_commit
from shardlog.sources.record_log import write_log

SHARDS5 = shard_bounds(5)
SHARDS500 = shard_bounds(500)
ACK_TIMEOUT_S = 600
BATCH = 100
_logs: dict[tuple, str] = {}
_schemas: dict[tuple, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events, as a table or given as a stream, as records with key hash."""
    e = table(spark, sf_dir, "events") if events is None else events
    return e.select(
        "event_id",
        "ts",
        F.col("event_type").alias("stream_name"),
        F.col("user_id").cast("string").alias("key"),
        F.lit(FLAG_JSON).alias("flag"),
        F.create_map(F.lit("type"), "event_type").alias("attributes"),
        F.col("props").alias("payload"),
        F.octet_length("props").cast("bigint").alias("n_bytes"),
        hash_key(F.col("user_id").cast("string")).alias("hash_key"),
    )


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(records(spark, sf_dir), SHARDS5)


def numbered(spark: SparkSession, sf_dir: str, parts: list[str] = ["shard_id"]) -> DataFrame:  # noqa: B006
    """Sharded records with batch ids and publish times, computed anew."""
    cut = batch_by_count(sharded(spark, sf_dir), parts, ["ts", "event_id"], BATCH)
    return stamp_publish_time(cut.drop("rn"), parts)


def log(spark: SparkSession, sf_dir: str, parts: tuple[str, ...] = ("shard_id",)) -> DataFrame:
    """The stored log of ``numbered``; written at first use in a session."""
    at = (spark.sparkContext.applicationId, sf_dir, parts)
    if at not in _logs:
        rows = numbered(spark, sf_dir, list(parts))
        path = scratch_path(spark, "log")
        write_log(rows, path, list(parts))
        record_commit(spark.read.schema(rows.schema).parquet(path), path, 0, list(parts))
        _logs[at], _schemas[at] = path, rows.schema
    return spark.read.schema(_schemas[at]).parquet(_logs[at])


def log_path(spark: SparkSession, sf_dir: str) -> str:
    log(spark, sf_dir)
    return _logs[(spark.sparkContext.applicationId, sf_dir, ("shard_id",))]


def log_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_directory(spark, log_path(spark, sf_dir))


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as five streams, one per event type, of five shards each."""
    return log(spark, sf_dir, ("stream_name", "shard_id"))


def stream_log_path(spark: SparkSession, sf_dir: str) -> str:
    stream_log(spark, sf_dir)
    return _logs[(spark.sparkContext.applicationId, sf_dir, ("stream_name", "shard_id"))]


def stream_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_directory(spark, stream_log_path(spark, sf_dir), f"stream_name string, {SHARD_TYPE}")


def as_of(spark: SparkSession, sf_dir: str) -> datetime:
    return table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]


def rid() -> Column:
    return record_id_text().alias("rid")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the log, delivered once when it happened."""
    return log(spark, sf_dir).select(
        F.lit("s1").alias("sub_id"),
        F.concat(F.lit("c"), (F.col("shard_id") + F.col("batch_id")) % 3).alias("consumer_name"),
        "shard_id", "batch_id", "batch_index", "event_id", "n_bytes",
        F.col("ts").alias("delivered_at"),
        (F.col("event_id") % 97 == 0).alias("failed"),
    )


def acks(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    now = as_of(spark, sf_dir)
    never = (F.col("event_id") % 7 == 0) & (F.col("delivered_at") >= F.lit("2024-01-11").cast("timestamp_ntz"))
    acked = F.col("delivered_at") + F.make_dt_interval(secs=((F.col("event_id") * 37) % 1800).cast("decimal(18,6)"))
    return (
        deliveries(spark, sf_dir)
        .where(~never)
        .select("sub_id", "shard_id", "batch_id", "batch_index", acked.alias("acked_at"), *more)
        .where(F.col("acked_at") <= F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"))
    )


# --- the same in SQL -------------------------------------------------------

def shard_values(bounds: list[tuple[int, str, str]]) -> str:
    return ", ".join(f"({i}::BIGINT, '{start}')" for i, start, _ in bounds)


_REC = f"""
sh(shard_id, start_key) AS (VALUES {shard_values(SHARDS5)}),
ev AS (
  SELECT event_id, ts, user_id, event_type, event_type AS stream_name, props, CAST(user_id AS VARCHAR) AS key,
         md5(CAST(user_id AS VARCHAR)) AS hash_key, CAST(strlen(props) AS BIGINT) AS n_bytes
  FROM events),
rec AS (SELECT ev.*, sh.shard_id FROM ev ASOF JOIN sh ON ev.hash_key >= sh.start_key)"""


def _numbered_sql(parts: str) -> str:
    return f"""WITH RECURSIVE {_REC},
ord AS (SELECT *, row_number() OVER (PARTITION BY {parts} ORDER BY ts, event_id) AS rn FROM rec),
ids AS (SELECT *, (rn - 1) // 100 + 1 AS batch_id, CAST((rn - 1) % 100 AS INTEGER) AS batch_index FROM ord),
numbered AS (
  SELECT *, max(ts) OVER (PARTITION BY {parts}, batch_id) AS publish_time,
         concat_ws('-', shard_id, batch_id, batch_index) AS rid
  FROM ids)"""


REC_SQL = f"WITH RECURSIVE {_REC}"
NUMBERED_SQL = _numbered_sql("shard_id")
STREAMS_SQL = _numbered_sql("stream_name, shard_id")
SUB_SQL = f"""{NUMBERED_SQL},
now AS (SELECT max(ts) AS t FROM events),
deliveries AS (
  SELECT 's1' AS sub_id, 'c' || ((shard_id + batch_id) % 3) AS consumer_name, shard_id, batch_id, batch_index,
         rid, event_id, n_bytes, ts AS delivered_at, event_id % 97 = 0 AS failed
  FROM numbered),
acks AS (
  SELECT * FROM (
    SELECT sub_id, shard_id, batch_id, batch_index, rid, delivered_at + to_seconds((event_id * 37) % 1800) AS acked_at
    FROM deliveries WHERE NOT (event_id % 7 = 0 AND delivered_at >= TIMESTAMP '2024-01-11'))
  WHERE acked_at <= (SELECT t FROM now))"""
