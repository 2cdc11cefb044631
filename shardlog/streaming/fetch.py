"""Streams of packed batches, opened as they come, with a policy for bad ones."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.operators.packing import unpack_batches
from shardlog.sources.record_log import write_log
from shardlog.streaming.ingest import run_available

POLICIES = ("skip", "fail", "stop")
STOPPED = "fetch stopped at a bad batch"


def fetcher(out: str, parts: list[str], on_error: str = "skip"):
    """A ``foreachBatch`` function that writes the records of packed batches below
    ``out``/records, and the bad batches with their ``status`` below ``out``/bad.

    ``skip`` goes on after a bad batch. ``fail`` delivers nothing of its micro-batch.
    ``stop`` delivers of each part what comes before its first bad batch, and ends the
    stream. Neither of these commits the micro-batch: once its files are mended, the
    stream goes on with it and replaces what it has left.
    """
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}, got {on_error!r}")

    def deliver(df: DataFrame, epoch: int) -> None:
        good, bad = unpack_batches(df, parts, "fail" if on_error == "fail" else "skip")
        bad = bad.select(*parts, "batch_id", "status")
        bad.write.mode("overwrite").parquet(f"{out}/bad/epoch={epoch}")
        stopped = None
        if on_error == "stop":
            found = df.sparkSession.read.schema(bad.schema).parquet(f"{out}/bad/epoch={epoch}")
            first = F.broadcast(found.groupBy(*parts).agg(F.min("batch_id").alias("_first")))  # a row per shard
            good = good.join(first, parts, "left").where("_first is null or batch_id < _first").drop("_first")
            stopped = found.first()
        write_log(good, f"{out}/records/epoch={epoch}", parts, mode="overwrite")
        if stopped is not None:
            raise RuntimeError(f"{STOPPED}: {stopped}")

    return deliver


def fetch_available(stream: DataFrame, out: str, parts: list[str], on_error: str = "skip") -> bool:
    """Fetch all there is now; false if the policy ``stop`` has ended the stream."""
    try:
        run_available(stream.writeStream.foreachBatch(fetcher(out, parts, on_error)), f"{out}/checkpoint")
    except StreamingQueryException as ended:
        if on_error == "stop" and STOPPED in str(ended):
            return False
        raise
    return True


def read_fetched(stream: DataFrame, out: str, parts: list[str]) -> DataFrame:
    """The records delivered below ``out``."""
    good, _ = unpack_batches(stream, parts)
    return stream.sparkSession.read.schema(good.schema).option("basePath", f"{out}/records").parquet(f"{out}/records")
