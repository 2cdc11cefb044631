"""Ack timeouts of a running subscription: two streams joined within an interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.model import DEFAULT_ACK_TIMEOUT_SECONDS, check_positive
from shardlog.operators.subscriptions import RECORD


def _seconds(n: int) -> Column:
    # A literal: Spark derives from it how long state is kept.
    return F.expr(f"interval {int(n)} seconds")


def timed_out(deliveries: DataFrame, acks: DataFrame, timeout_s: int = DEFAULT_ACK_TIMEOUT_SECONDS, late: str = "10 minutes", before_s: int | None = None) -> DataFrame:
    """Of two streams, the deliveries that had no ack when their time was up, with ``due``.

    A stream-stream left outer join: an ack counts from ``before_s`` before a delivery (by
    default a timeout: it may answer an earlier send of the record) to ``timeout_s`` after it.
    Zone-less times are taken as UTC. Either stream may come up to ``late`` out of order. A delivery is given out when both
    watermarks have passed its due time, so an ack on its way is waited for; state is kept
    of the deliveries and acks of that span alone, dealt by record. Repeated acks match
    as often, and rows that matched are not given out.
    """
    check_positive("ack_timeout_s", timeout_s)
    before_s = timeout_s if before_s is None else before_s
    # Watermarks need a time with a zone.
    timed = lambda df, at: df.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    sent = timed(deliveries, "delivered_at").withColumnRenamed("_at", "_sent").alias("d")
    heard = timed(acks, "acked_at").select(*[F.col(c).alias(f"_{c}") for c in RECORD], F.col("_at").alias("_heard"))
    same = [F.col(f"d.{c}") == F.col(f"_{c}") for c in RECORD]
    in_time = (F.col("_heard") >= F.col("_sent") - _seconds(before_s)) & (F.col("_heard") <= F.col("_sent") + _seconds(timeout_s))
    on = in_time
    for c in same:
        on = c & on
    unheard = sent.join(heard, on, "left_outer").where("_heard is null")
    return unheard.select("d.*", (F.col("delivered_at") + _seconds(timeout_s)).alias("due")).drop("_sent")
