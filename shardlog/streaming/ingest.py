"""Streams of records into batched logs.

Each micro-batch is cut by the same operators as a bounded table, going on from
the state the micro-batch before left for each shard: one small row per shard.
So a hot shard is as parallel here as there, and an open batch survives.
Records are laid out as an appended log is, a directory per shard, so that reads of
a shard prune here too. Output, its rows of the log's directory and the state are written
under the micro-batch's number and replaced when it is run again, so a retried micro-batch leaves one copy.

Time goes on with the newest record of any shard: an open batch whose timer has run out by
then is closed, also that of a shard to which nothing comes any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardlog.operators.batching import Rule, cut_batches
from shardlog.session import store
from shardlog.sources.directory import read_directory, record_commit
from shardlog.sources.record_log import write_log

STATE = "t0 bigint, held bigint, size bigint, batches bigint, records bigint, clock bigint"
# The clock before any record.
_NEVER = -(1 << 62)


def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream: a folder, or a glob where it may be one file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_available(writer, checkpoint: str) -> None:
    """Run a streaming query over all there is now, then stop."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_steadily(writer, checkpoint: str, every: str = "10 seconds"):
    """Start a streaming query that goes on until stopped; returns it."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def _read_state(spark: SparkSession, out: str, epoch: int, types: str) -> tuple[DataFrame | None, int]:
    """Per shard its state with batches and records so far; and the clock."""
    if epoch < 0:
        return None, _NEVER
    state = spark.read.schema(f"{types}{STATE}").parquet(f"{out}/state/epoch={epoch}")
    clock = state.agg(F.max("clock")).first()[0]
    return state.drop("clock"), _NEVER if clock is None else clock


def timed_state(state: DataFrame, clock: int, rule: Rule) -> DataFrame:
    """The states of shards when the timer has been watched until ``clock``."""
    if rule.timeout_us <= 0:
        return state
    t0, zero = F.col("t0"), F.lit(0).cast("bigint")
    ran_out = t0 + rule.timeout_us <= clock
    ticked = t0 + F.floor((F.lit(clock) - t0).cast("decimal(20,0)") / rule.timeout_us).cast("bigint") * rule.timeout_us
    return state.select(
        *[c for c in state.columns if c not in ("t0", "held", "size")],
        F.when(ran_out, ticked).otherwise(t0).alias("t0"), *[F.when(ran_out, zero).otherwise(F.col(c)).alias(c) for c in ("held", "size")],
    )


def batcher(out: str, parts: list[str], ts: str, order: list[str], n_bytes: str, rule: Rule, late_s: int = 0):
    """A ``foreachBatch`` function that cuts records into batches below ``out``.

    ``late_s`` is how far the clock stays behind the newest record, for shards whose
    records come that much later than those of others.
    """

    def append(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        types = _part_types(df.schema, parts)
        state, clock = _read_state(spark, out, epoch - 1, types)
        cut = cut_batches(df, parts, ts, order, n_bytes, rule, state)
        rows = cut.records.drop("rn")
        write_log(rows, f"{out}/records/epoch={epoch}", parts, mode="overwrite")
        record_commit(spark.read.schema(rows.schema).parquet(f"{out}/records/epoch={epoch}"), out, epoch, parts, ts, n_bytes)
        newest = read_directory(spark, out, types.rstrip(", ")).where(F.col("commit") == epoch).agg(F.max(F.unix_micros(F.col("last_ts").cast("timestamp")))).first()[0]
        clock = clock if newest is None else max(clock, newest - late_s * 1_000_000)
        ends = cut.tails if state is None else state.join(cut.tails, parts, "left_anti").unionByName(cut.tails)
        ends = timed_state(ends, clock, rule).withColumn("clock", F.lit(clock))
        ends.coalesce(1).write.mode("overwrite").parquet(f"{out}/state/epoch={epoch}")  # a row per shard

    return append


def _part_types(schema: StructType, parts: list[str]) -> str:
    return "".join(f"{p} {schema[p].dataType.simpleString()}, " for p in parts)


def read_batched(spark: SparkSession, out: str, schema: StructType, parts: list[str], flush: bool = True) -> DataFrame:
    """The log written by ``batcher``, with publish times.

    Records hold the publish time of their batch as it was when their micro-batch
    ended. Of the few batches that went on in another one, at most one per shard and
    micro-batch, the directory has the true one; no record is shuffled for it.

    ``flush`` counts the batches still open as closed, as stopping the producer
    does; otherwise they are left out until they close.
    """
    added = {"batch_id": "long", "batch_index": "integer", "publish_time": "timestamp_ntz", "epoch": "integer"}
    full = StructType(list(schema.fields))
    for name, kind in added.items():
        full = full.add(name, kind)
    records = spark.read.schema(full).option("basePath", f"{out}/records").parquet(f"{out}/records").drop("epoch")
    types = _part_types(schema, parts)
    batches = read_directory(spark, out, types.rstrip(", ")).groupBy(*parts, "batch_id").agg(
        F.min("commit").alias("first"), F.max("commit").alias("last"), F.max("publish_time").alias("_published")
    )
    # Written so that the join is planned by its true size.
    continued = store(batches.where("first < last").drop("first", "last"), "continued")
    records = records.join(continued, [*parts, "batch_id"], "left").withColumn("publish_time", F.coalesce("_published", "publish_time")).drop("_published")
    if not flush:
        states = spark.read.schema(f"{types}{STATE}, epoch int").option("basePath", f"{out}/state").parquet(f"{out}/state")
        last = states.groupBy(*parts).agg(F.max_by(F.struct("held", "batches"), "epoch").alias("s"))
        open_ = store(last.where("s.held > 0").select(*parts, F.col("s.batches").alias("_open")), "open")  # a row per shard
        records = records.join(open_, parts, "left").where("_open is null or batch_id < _open").drop("_open")
    return records
