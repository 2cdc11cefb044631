"""Continuous queries: derived streams and views kept up to date."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardlog.streaming.ingest import run_available


def stream_as_select(stream: DataFrame, target: str, checkpoint: str, shard_by: list[str] | None = None) -> None:
    """Write a query's rows to a derived stream, itself readable as one."""
    writer = stream.writeStream.format("parquet").option("path", target).outputMode("append")
    run_available(writer.partitionBy(*shard_by) if shard_by else writer, checkpoint)


def keep_view(grouped: DataFrame, changes: str, checkpoint: str, keys: list[str] | None = None, compact_every: int = 0) -> StructType:
    """Keep an aggregate up to date: each micro-batch writes the groups it changed
    under its own number, which a rerun replaces. Returns the changes' schema.

    With ``compact_every`` the changes of so many micro-batches are folded into a
    snapshot each time, by the view's ``keys``, which bounds the files of the view.
    """
    if compact_every and not keys:
        raise ValueError("compaction needs the view's keys")

    def upsert(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{changes}/epoch={epoch}")
        if compact_every and (epoch + 1) % compact_every == 0:
            compact_view(df.sparkSession, changes, grouped.schema, keys, epoch)

    run_available(grouped.writeStream.outputMode("update").foreachBatch(upsert), checkpoint)
    return grouped.schema


def _snapshots(spark: SparkSession, changes: str) -> list[int]:
    """The numbers of the snapshots that were finished, the last one first."""
    try:
        pointers = spark.read.schema("made boolean, upto int").option("basePath", f"{changes}/_pointers").parquet(f"{changes}/_pointers")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r["upto"] for r in pointers.select("upto").distinct().orderBy(F.col("upto").desc()).collect()]  # two, or three after a crash


def _latest(spark: SparkSession, changes: str, schema: StructType, keys: list[str], upto: int | None = None) -> DataFrame:
    """The latest values of each group, with the ``epoch`` that they are of."""
    values = [f.name for f in schema if f.name not in keys]
    full = StructType(list(schema.fields)).add("epoch", "integer")
    rows = spark.read.schema(full).option("basePath", changes).parquet(changes)
    if upto is not None:
        rows = rows.where(F.col("epoch") <= upto)
    for snapshot in _snapshots(spark, changes)[:1]:
        rows = rows.where(F.col("epoch") > snapshot).unionByName(spark.read.schema(full).parquet(f"{changes}/_snapshots/upto={snapshot}"))
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values, "epoch"), "epoch").alias("v"))
    return latest.select(*keys, "v.*")


def read_view(spark: SparkSession, changes: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The view as it is now: the latest values of each group, from the last snapshot
    and the changes after it."""
    return _latest(spark, changes, schema, keys).drop("epoch")


def compact_view(spark: SparkSession, changes: str, schema: StructType, keys: list[str], upto: int) -> None:
    """Fold the changes up to a micro-batch into a snapshot.

    The pointer to it is written last, so a compaction that broke off changes nothing
    and is made anew. What the snapshot before the last made superfluous is removed then,
    and not what the last did: reads that began before the pointer still find it.
    """
    before = _snapshots(spark, changes)
    if before and before[0] >= upto:
        return
    _latest(spark, changes, schema, keys, upto).write.mode("overwrite").parquet(f"{changes}/_snapshots/upto={upto}")
    spark.createDataFrame([(True,)], "made boolean").coalesce(1).write.mode("overwrite").parquet(f"{changes}/_pointers/upto={upto}")
    if before:
        for older in before[1:]:
            _remove(spark, f"{changes}/_pointers/upto={older}")
            _remove(spark, f"{changes}/_snapshots/upto={older}")
        for epoch in range(min(before[1:], default=-1) + 1, before[0] + 1):
            _remove(spark, f"{changes}/epoch={epoch}")


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def daily_totals(stream: DataFrame, ts: str, keys: list[str], n_bytes: str, late: str | None = None) -> DataFrame:
    """Records and bytes per day and key. Zone-less times are taken as UTC.

    Every record counts, however late, at the price of a state row kept for each
    day and key. ``late`` closes days that long past the newest record instead,
    which bounds the state and ignores records that come later still.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = timed.withWatermark(ts, late) if late else timed
    return timed.groupBy(F.window(ts, "1 day"), *keys).agg(F.count("*").alias("n"), F.sum(n_bytes).alias("bytes")).select(
        _day(), *keys, "n", "bytes"
    )


def _day() -> Column:
    return F.col("window.start").cast("timestamp_ntz").alias("day")
