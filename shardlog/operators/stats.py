"""Counters and rates over append, read and subscription logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.model import ERROR_UNKNOWN_STAT
from shardlog.operators.subscriptions import batch_acks, unacked
from shardlog.session import store

STREAM_STATS = ["append_in_bytes", "append_in_records", "append_total", "append_failed", "read_in_bytes", "read_in_batches"]
SUB_STATS = [
    "send_out_bytes", "send_out_records", "send_out_records_failed", "resend_records", "resend_records_failed",
    "received_acks", "request_messages", "response_messages", "check_list_size",
]


BATCH = ["shard_id", "batch_id"]


def to_long(wide: DataFrame, stats: list[str], entity: str) -> DataFrame:
    """(stat, entity, value) rows of a table with a column per stat."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("bigint").alias("value")) for s in stats]))
    return wide.select(F.col(entity).alias("entity"), pairs.alias("p")).select("p.stat", "entity", "p.value")


def _side_by_side(counted: list[DataFrame], entity: str, stats: list[str]) -> DataFrame:
    """Counts of several logs, each a row per entity, as one row per entity."""
    rows = counted[0]
    for more in counted[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.groupBy(entity).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stats])


def stream_counters(appends: DataFrame, reads: DataFrame) -> DataFrame:
    """Six counters per stream. ``appends`` has a row per record with ``error``,
    null where its batch was stored; a batch is one append request."""
    stored = F.col("error").isNull()
    # A row per batch first: a log may begin or end inside one.
    wrote = (
        appends.groupBy("stream_name", *BATCH)
        .agg(F.sum(F.when(stored, F.col("n_bytes"))).alias("_bytes"), F.count_if(stored).alias("_records"), F.max(~stored).alias("_failed"))
        .groupBy("stream_name")
        .agg(
            F.coalesce(F.sum("_bytes"), F.lit(0)).alias("append_in_bytes"),
            F.sum("_records").alias("append_in_records"),
            F.count("*").alias("append_total"),
            F.count_if("_failed").alias("append_failed"),
        )
    )
    read = (
        reads.groupBy("stream_name", *BATCH)
        .agg(F.sum("n_bytes").alias("_bytes"))
        .groupBy("stream_name")
        .agg(F.sum("_bytes").alias("read_in_bytes"), F.count("*").alias("read_in_batches"))
    )
    return to_long(_side_by_side([wrote, read], "stream_name", STREAM_STATS), STREAM_STATS, "stream_name")


def sub_counters(sends: DataFrame, resends: DataFrame, acks: DataFrame) -> DataFrame:
    """Nine counters per subscription. ``sends`` and ``resends`` carry ``failed``, and
    resends how many they are (``n_resends``)."""
    firsts = (
        sends.groupBy("sub_id", *BATCH)
        .agg(
            F.sum(F.when(~F.col("failed"), F.col("n_bytes"))).alias("_bytes"),
            F.count_if(~F.col("failed")).alias("_sent"),
            F.count_if("failed").alias("_failed"),
        )
        .groupBy("sub_id")
        .agg(
            F.coalesce(F.sum("_bytes"), F.lit(0)).alias("send_out_bytes"),
            F.sum("_sent").alias("send_out_records"),
            F.sum("_failed").alias("send_out_records_failed"),
            F.count("*").alias("response_messages"),
        )
    )
    again = resends.groupBy("sub_id").agg(
        F.coalesce(F.sum(F.when(~F.col("failed"), F.col("n_resends"))), F.lit(0)).alias("resend_records"),
        F.coalesce(F.sum(F.when(F.col("failed"), F.col("n_resends"))), F.lit(0)).alias("resend_records_failed"),
    )
    got = acks.groupBy("sub_id").agg(F.count("*").alias("received_acks"))
    waiting = unacked(sends, acks).groupBy("sub_id").agg(F.count("*").alias("check_list_size"))
    asked = batch_acks(acks).tails.select("sub_id", F.col("batches").alias("request_messages"))
    return to_long(_side_by_side([firsts, again, got, waiting, asked], "sub_id", SUB_STATS), SUB_STATS, "sub_id")


def requested_stats(stats: DataFrame, wanted: list[str]) -> DataFrame:
    """Values of the wanted stats and, for names that do not exist, an error row. A
    known stat of which there are no values has a row without value and error."""
    spark = stats.sparkSession
    known = {*STREAM_STATS, *SUB_STATS}
    rows = [(w, None if w in known else ERROR_UNKNOWN_STAT) for w in wanted]
    asked = F.broadcast(spark.createDataFrame(rows, "stat string, error string"))  # a row per name asked for
    return asked.join(stats, "stat", "left").select("stat", "entity", "value", "error")


RATE_METHODS = {
    "append_in_bytes": lambda: F.col("n_bytes"),
    "append_in_records": lambda: F.lit(1),
    "append_in_batches": lambda: F.lit(1),
    "read_in_bytes": lambda: F.col("n_bytes"),
    "read_in_batches": lambda: F.lit(1),
}


def rates(log: DataFrame, method: str, intervals_s: list[int], as_of: datetime, stream: str | None = None, directory: DataFrame | None = None) -> DataFrame:
    """Per stream and interval, in the order asked for, the amount per second over
    the last interval, up to ``as_of``: a sum per interval, made long afterwards. A batch
    counts when its first record came. Streams without such rows have rates of 0. ``log``
    holds the records appended, or for the methods of reads those read, ``ts`` being when.

    With the log's ``directory`` batches are summed up there. Records are only read of
    the batches in which an interval begins or the clock stops, and none to count batches.
    """
    if method not in RATE_METHODS:
        raise ValueError(f"method must be one of {sorted(RATE_METHODS)}, got {method!r}")
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    since = [now - F.make_dt_interval(secs=F.lit(s).cast("decimal(18,6)")) for s in intervals_s]
    longest = since[intervals_s.index(max(intervals_s))]
    of = lambda df: df if stream is None else df.where(F.col("stream_name") == stream)
    by_batch, names = method.endswith("_in_batches"), [f"_{i}" for i in range(len(intervals_s))]
    rows, listed = of(log), None if directory is None else of(directory)
    # The streams alone: of a log partitioned by them, no column is read for it.
    every = (rows if listed is None else listed).select("stream_name").distinct()
    if listed is not None:
        batches = listed.groupBy("stream_name", *BATCH).agg(
            F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_records").alias("n_records")
        )
        if by_batch:
            rows = batches.withColumn("ts", F.col("first_ts"))
    elif by_batch:
        rows = rows.groupBy("stream_name", *BATCH).agg(F.min("ts").alias("ts"))
    amount = RATE_METHODS[method]()
    if listed is None or by_batch:
        recent = rows.where((F.col("ts") > longest) & (F.col("ts") <= now))
        parts = recent.select("stream_name", *[F.when(F.col("ts") > s, amount).alias(n) for s, n in zip(since, names)])
    else:
        batches = batches.where((F.col("last_ts") > longest) & (F.col("first_ts") <= now))
        whole = [(F.col("first_ts") > s) & (F.col("last_ts") <= now) for s in since]
        held = F.col("n_bytes") if method.endswith("_in_bytes") else F.col("n_records")
        parts = batches.select("stream_name", *[F.when(w, held).alias(n) for w, n in zip(whole, names)])
        # Written so that the join is planned by its true size: about a batch per shard and interval.
        edges = store(batches.select("stream_name", *BATCH, *[w.alias(f"w{n}") for w, n in zip(whole, names)]).where(" or ".join(f"not w{n}" for n in names)), "edges")
        inside = rows.where((F.col("ts") > longest) & (F.col("ts") <= now)).join(edges, ["stream_name", *BATCH])
        parts = parts.unionByName(inside.select("stream_name", *[F.when(~F.col(f"w{n}") & (F.col("ts") > s), amount).alias(n) for s, n in zip(since, names)]))
    sums = parts.groupBy("stream_name").agg(*[F.sum(n).alias(n) for n in names])
    streams = every.join(sums, "stream_name", "left").select("stream_name", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
    values = F.array(
        *[
            F.struct(F.lit(i).alias("ord"), F.lit(s).cast("bigint").alias("interval_s"), (F.col(n) / s).alias("rate"))
            for i, (s, n) in enumerate(zip(intervals_s, names))
        ]
    )
    return streams.select("stream_name", F.explode(values).alias("v")).select("stream_name", "v.*")
