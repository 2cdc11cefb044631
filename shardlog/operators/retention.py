"""Trimming and ageing of record logs. Each returns the records that stay;
write them to a new path, as Spark cannot overwrite the path it reads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardlog.functions.ids import parse_record_id, record_id_text
from shardlog.functions.offsets import trim_predicate
from shardlog.model import Offset
from shardlog.session import store
from shardlog.sources.directory import files_in_time


def trim_stream(log: DataFrame, offset: Offset) -> DataFrame:
    """Drop everything up to and including the offset. A record without a time stays
    when the offset is a time."""
    return log.where(~F.coalesce(trim_predicate(offset), F.lit(False)))


def trim_shard(log: DataFrame, shard_id: int, offset: Offset) -> DataFrame:
    """Drop one shard's records up to and including the offset."""
    return log.where((F.col("shard_id") != shard_id) | ~F.coalesce(trim_predicate(offset), F.lit(False)))


def parse_ids(texts: DataFrame, text_col: str = "rid") -> tuple[DataFrame, DataFrame]:
    """Record ids from text, and the malformed rows."""
    parsed = texts.withColumn("_id", parse_record_id(F.col(text_col)))
    good = parsed.where("_id is not null").select(*texts.columns, "_id.shard_id", "_id.batch_id", "_id.batch_index")
    return good, parsed.where("_id is null").drop("_id")


def trim_points(ids: DataFrame) -> DataFrame:
    """Oldest id given for each shard. The id 0-0 of a shard stands for its start
    and only counts where the shard has no other."""
    position = F.struct("batch_id", "batch_index")
    real = F.when((F.col("batch_id") > 0) | (F.col("batch_index") > 0), position)
    return (
        ids.groupBy("shard_id")
        .agg(F.coalesce(F.min(real), F.min(position)).alias("p"))
        .select("shard_id", "p.batch_id", "p.batch_index")
        .withColumn("rid", record_id_text())
    )


def trim_shards(log: DataFrame, points: DataFrame) -> DataFrame:
    """Drop the records strictly before their shard's point; shards without a
    point keep everything. The points, at most a row per shard, are written first
    so that the join is planned by their true size."""
    at = store(points.select("shard_id", F.struct("batch_id", "batch_index").alias("_point")), "points")
    here = F.struct("batch_id", "batch_index")
    return log.join(at, "shard_id", "left").where(F.col("_point").isNull() | (here >= F.col("_point"))).drop("_point")


def within_backlog(now: datetime, seconds: Column) -> Column:
    limit = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz") - F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return (seconds > 0) & (F.col("publish_time") >= limit)


def keep_backlog(log: DataFrame, backlog: dict[str, int], now: datetime) -> DataFrame:
    """Keep the records younger than their stream's backlog seconds. A stream
    with 0 keeps no backlog; one not listed is left alone."""
    spark = log.sparkSession
    table = F.broadcast(spark.createDataFrame(list(backlog.items()), "stream_name string, backlog_s bigint"))  # a row per stream
    seconds = F.col("backlog_s")
    # Implied by what follows, and there to reach the scan.
    oldest = now - timedelta(seconds=max([0, *backlog.values()]))
    other = F.col("stream_name").isNull() | ~F.col("stream_name").isin(list(backlog))
    log = log.where(other | (F.col("publish_time") >= F.lit(oldest.isoformat(sep=" ")).cast("timestamp_ntz")))
    kept = log.join(table, "stream_name", "left").where(seconds.isNull() | within_backlog(now, seconds))
    return kept.drop("backlog_s")


def expiry_of_files(directory: DataFrame, backlog: dict[str, int], now: datetime) -> DataFrame:
    """(stream_name, file, n_records, keeps) of each file of a log of streams: ``all`` of
    its records are within the stream's backlog, ``none`` is, or ``some`` may be. Files
    of ``none`` can be deleted as they are."""
    spark = directory.sparkSession
    table = F.broadcast(spark.createDataFrame(list(backlog.items()), "stream_name string, backlog_s bigint"))  # a row per stream
    limit = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz") - F.make_dt_interval(secs=F.col("backlog_s").cast("decimal(18,6)"))
    keeps = (
        F.when(F.col("backlog_s").isNull(), "all")
        .when((F.col("backlog_s") <= 0) | (F.col("newest") < limit), "none")
        .when(F.col("oldest") >= limit, "all")
        .otherwise("some")
    )
    files = files_in_time(directory, ["stream_name"]).join(table, "stream_name", "left")
    return files.select("stream_name", "file", "n_records", keeps.alias("keeps"))


def keep_backlog_files(directory: DataFrame, path: str, schema: StructType, backlog: dict[str, int], now: datetime) -> DataFrame:
    """What ``keep_backlog`` keeps of the log at ``path``, by its directory: files whose
    records have all expired are not opened, those whose records all stay are read as they
    are, and only the files that straddle a limit are filtered row by row.

    The driver sees a row per file, as Spark's own listing of the log does.
    """
    spark = directory.sparkSession
    named: dict[str, list[str]] = {"all": [], "some": []}
    for r in expiry_of_files(directory, backlog, now).where("keeps <> 'none'").select("file", "keeps").distinct().toLocalIterator():
        named[r["keeps"]].append(r["file"])
    reader = lambda files: spark.read.schema(schema).option("basePath", path).parquet(*files)
    kept = spark.createDataFrame([], schema)
    if named["all"]:
        kept = reader(named["all"])
    if named["some"]:
        some = keep_backlog(reader(named["some"]), backlog, now).select(*kept.columns)
        kept = kept.unionByName(some) if named["all"] else some
    return kept
