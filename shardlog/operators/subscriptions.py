"""Subscriptions over logs of deliveries and acks.

``deliveries(sub_id, consumer_name, shard_id, batch_id, batch_index, n_bytes,
delivered_at, ...)`` and ``acks(sub_id, shard_id, batch_id, batch_index, acked_at)``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.model import ACK_BATCH_COUNT, ACK_BATCH_SECONDS, ID_COLUMNS, check_positive
from shardlog.operators.batching import Cut, Rule, cut_batches
from shardlog.operators.sequence import running_peak
from shardlog.session import store
from shardlog.sources.record_log import tail_ids

RECORD = ["sub_id", *ID_COLUMNS]


def after_tail(log: DataFrame, tails: DataFrame) -> DataFrame:
    """Records behind a stored tail; a shard without a tail is new and read whole.
    The tails, at most a row per shard, are written first so that the join is
    planned by their true size, and stay what they were when the log grows."""
    at = store(tails.select("shard_id", F.struct("batch_id", "batch_index").alias("_tail")), "tails")
    here = F.struct("batch_id", "batch_index")
    return log.join(at, "shard_id", "left").where(F.col("_tail").isNull() | (here > F.col("_tail"))).drop("_tail")


def start_position(log: DataFrame, start: str, created_at: datetime | None = None) -> DataFrame:
    """Records a subscription made at ``created_at`` gets: all for ``earliest``,
    for ``latest`` those after the tail each shard had then."""
    if start == "earliest":
        return log
    if start != "latest":
        raise ValueError(f"start must be earliest or latest, got {start!r}")
    made = F.lit(created_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return after_tail(log, tail_ids(log.where(F.col("publish_time") <= made)))


def unacked(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Deliveries whose record has no ack. Acks are made distinct first, in the
    shuffle the join needs anyway, so repeated acks of one record do not pile up."""
    return deliveries.join(acks.select(*RECORD).distinct(), RECORD, "left_anti")


def with_acks(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Deliveries with ``acked_at``, the first ack of the record or null."""
    first = acks.groupBy(*RECORD).agg(F.min("acked_at").alias("acked_at"))
    return deliveries.join(first, RECORD, "left")


def latest_sends(deliveries: DataFrame) -> DataFrame:
    """The latest delivery of each record; dealt by record, as the join with acks is."""
    latest = W.partitionBy(*RECORD).orderBy(F.col("delivered_at").desc())
    return deliveries.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1").drop("_nth")


def redeliveries(deliveries: DataFrame, acks: DataFrame, timeout_s: int, as_of: datetime) -> DataFrame:
    """Deliveries that were sent again, with how often and when first and last: every
    ``timeout_s`` after the delivery until the record's first ack, or ``as_of``. The
    resends are counted and not made into rows, as their number has no limit.

    Of a record with several deliveries up to ``as_of`` the latest alone is sent again:
    each delivery starts the timer anew. What came later is not seen.
    """
    check_positive("ack_timeout_s", timeout_s)
    deliveries = latest_sends(deliveries.where(F.col("delivered_at") <= F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    step = timeout_s * 1_000_000
    sent, end = micros(F.col("delivered_at")), micros(F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))
    # The last instant at which the record still waits: an ack at the due time stops it.
    waits = F.least(end, F.coalesce(micros(F.col("acked_at")) - 1, end))
    due = lambda n: F.col("delivered_at") + F.make_dt_interval(secs=(n * timeout_s).cast("decimal(18,6)"))
    again = with_acks(deliveries, acks).withColumn("n_resends", F.floor((waits - sent) / step).cast("bigint")).where("n_resends > 0")
    return again.withColumn("first_resend", due(F.lit(1))).withColumn("last_resend", due(F.col("n_resends"))).drop("acked_at")


def number_attempts(sends: DataFrame) -> DataFrame:
    """Number the sends of each record from 1 by time."""
    return sends.withColumn("attempt", F.row_number().over(W.partitionBy(*RECORD).orderBy("delivered_at")))


def last_attempts(resent: DataFrame) -> DataFrame:
    """The last send of each of ``resent``, redeliveries of numbered sends: ``n_resends``
    attempts later, at the time of the last resend."""
    attempt = (F.col("attempt") + F.col("n_resends")).cast("int")
    return resent.withColumns({"attempt": attempt, "delivered_at": F.col("last_resend")})


def ack_latency(deliveries: DataFrame, acks: DataFrame, timeout_s: int) -> DataFrame:
    """Per consumer: acks in time, late and missing, and mean seconds to an ack."""
    pairs = with_acks(deliveries, acks)
    limit = F.col("delivered_at") + F.make_dt_interval(secs=F.lit(timeout_s).cast("decimal(18,6)"))
    seconds = (F.unix_micros(F.col("acked_at").cast("timestamp")) - F.unix_micros(F.col("delivered_at").cast("timestamp"))) / 1_000_000
    return pairs.groupBy("consumer_name").agg(
        F.count_if(F.col("acked_at") <= limit).alias("n_on_time"),
        F.count_if(F.col("acked_at") > limit).alias("n_late"),
        F.count_if(F.col("acked_at").isNull()).alias("n_missing"),
        F.avg(seconds).alias("avg_s"),
    )


def inflight_peaks(deliveries: DataFrame, acks: DataFrame, slice_: str = "minute") -> DataFrame:
    """Most unacked records at once in each minute of each subscription. A record
    stops waiting at its first ack; acks of what was never delivered don't count."""
    pairs = with_acks(deliveries, acks)
    steps = pairs.select("sub_id", F.col("delivered_at").alias("at"), F.lit(1).alias("step")).unionByName(
        pairs.where("acked_at is not null").select("sub_id", F.col("acked_at").alias("at"), F.lit(-1).alias("step"))
    )
    return running_peak(steps, ["sub_id"], "at", "step", slice_).withColumnRenamed("peak", "max_inflight")


def commit_frontier(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Per shard the last batch up to which every record is acked."""
    pairs = with_acks(deliveries, acks)
    return pairs.groupBy("sub_id", "shard_id").agg(
        F.coalesce(
            F.min(F.when(F.col("acked_at").isNull(), F.col("batch_id"))) - 1,
            F.max("batch_id"),
        ).alias("committed_batch")
    )


def batch_acks(acks: DataFrame, count: int = ACK_BATCH_COUNT, seconds: int = ACK_BATCH_SECONDS) -> Cut:
    """Group acks into requests of ``count`` ids or ``seconds``. Adds batch columns
    ``request_id`` and ``request_index`` to the records."""
    named = acks.withColumnsRenamed({"batch_id": "_b", "batch_index": "_i"})
    rule = Rule(count, timeout_us=seconds * 1_000_000)
    cut = cut_batches(named.withColumn("_none", F.lit(0)), ["sub_id"], "acked_at", ["shard_id", "_b", "_i"], "_none", rule)

    def place() -> DataFrame:
        out = cut.records.withColumnsRenamed({"batch_id": "request_id", "batch_index": "request_index"})
        return out.withColumnsRenamed({"_b": "batch_id", "_i": "batch_index"}).drop("_none", "rn", "publish_time")

    return Cut(cut.tails, place)


def consumers_of(deliveries: DataFrame) -> DataFrame:
    """Consumers that took part in a subscription, with the batches of which they
    received any record."""
    batches = deliveries.groupBy("sub_id", "consumer_name", "shard_id", "batch_id").agg(F.lit(1).alias("_"))
    return batches.groupBy("sub_id", "consumer_name").agg(F.count("*").alias("n_batches"))
