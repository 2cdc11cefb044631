"""The directory of a log: a row for each batch and file, written when records are.

It says how many records and bytes a batch has, when they came and where they lie, so
that tails, positions and expiry are found without reading records. A log's commits are
numbered. The records of a commit are written first, below ``commit=N``, then its rows of
the directory, which make it count. A commit that was lost in between is not in the
directory, and the next one takes its number and its place; one that is repeated replaces
itself. Spark's readers of the log pass over the directory, as its name has an underscore.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.model import Offset

SHARD_TYPE = "shard_id bigint"
_ROW = (
    "batch_id bigint, first_index int, last_index int, n_records bigint, n_bytes bigint, "
    "first_ts timestamp_ntz, last_ts timestamp_ntz, publish_time timestamp_ntz, file string"
)
# Batch numbers that running sums take together first.
BUCKET = 4096


def directory_of(path: str) -> str:
    return f"{path}/_directory"


def commit_path(path: str, number: int) -> str:
    return f"{path}/commit={number}"


def read_directory(spark: SparkSession, path: str, parts: str = SHARD_TYPE) -> DataFrame:
    """The directory of the log at ``path``, with the number of each row's ``commit``;
    empty if there is none. ``parts`` are the log's own columns, with types."""
    schema = f"{parts}, {_ROW}, commit int"
    try:
        return spark.read.schema(schema).option("basePath", directory_of(path)).parquet(directory_of(path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def next_commit(directory: DataFrame) -> int:
    last = directory.agg(F.max("commit")).first()[0]
    return 0 if last is None else last + 1


def record_commit(written: DataFrame, path: str, number: int, parts: list[str] = ["shard_id"], ts: str = "ts", n_bytes: str = "n_bytes") -> None:  # noqa: B006
    """Make the commit ``number`` count: list the batches of ``written``, a table as read
    from its files, in the directory. Ids, sizes and times alone are read."""
    found = written.select(*parts, "batch_id", "batch_index", F.col(n_bytes).cast("long").alias("n_bytes"), F.col(ts).alias("ts"), "publish_time", F.col("_metadata.file_path").alias("file"))
    rows = found.groupBy(*parts, "batch_id", "file").agg(
        F.min("batch_index").alias("first_index"),
        F.max("batch_index").alias("last_index"),
        F.count("*").alias("n_records"),
        F.sum("n_bytes").alias("n_bytes"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.max("publish_time").alias("publish_time"),
    )
    rows.write.mode("overwrite").parquet(f"{directory_of(path)}/commit={number}")


def tails(directory: DataFrame, parts: list[str] = ["shard_id"]) -> DataFrame:  # noqa: B006
    """Last record id of each shard."""
    last = F.max(F.struct("batch_id", F.col("last_index").alias("batch_index"))).alias("t")
    return directory.groupBy(*parts).agg(last).select(*parts, "t.batch_id", "t.batch_index")


def batches_between(directory: DataFrame, start: Offset = Offset.earliest(), until: Offset = Offset.empty(), parts: list[str] = ["shard_id"]) -> DataFrame:  # noqa: B006
    """(parts, batch_id, first, n): of each batch the records between two offsets, the
    first of them and how many. The records of a batch have no gaps."""
    rows = directory.groupBy(*parts, "batch_id").agg(F.min("first_index").alias("first"), F.max("last_index").alias("last"), F.max("publish_time").alias("publish_time"))
    for offset, nothing in ((start, "latest"), (until, "earliest")):
        if offset.kind == nothing:
            rows = rows.where(F.lit(False))
    batch = F.col("batch_id")
    if start.kind == "timestamp":
        rows = rows.where(F.col("publish_time") >= F.lit(start.at.isoformat(sep=" ")).cast("timestamp_ntz"))
    if until.kind == "timestamp":
        rows = rows.where(F.col("publish_time") <= F.lit(until.at.isoformat(sep=" ")).cast("timestamp_ntz"))
    if start.kind == "record":
        own = F.when(batch == start.batch_id, F.greatest("first", F.lit(start.batch_index))).otherwise(F.col("first"))
        rows = rows.where(batch >= start.batch_id).withColumn("first", own)
    if until.kind == "record":
        own = F.when(batch == until.batch_id, F.least("last", F.lit(until.batch_index))).otherwise(F.col("last"))
        rows = rows.where(batch <= until.batch_id).withColumn("last", own)
    return rows.where("first <= last").select(*parts, "batch_id", "first", (F.col("last") - F.col("first") + 1).cast("long").alias("n"))


def cut_points(batches: DataFrame, n: int, parts: list[str] = ["shard_id"]) -> DataFrame:  # noqa: B006
    """(parts, cut_batch, cut_index, cut_left): where each part's ``n``-th record lies, and
    which one of its batch it is, from 1. Parts of fewer records have no row.

    Running sums go over buckets of batches first, and then over the batches of the one
    bucket in which the record is, so no task has a row for every batch of a part.
    """
    bucket = F.floor(F.col("batch_id") / BUCKET).alias("bucket")
    in_order = lambda by: W.partitionBy(*parts).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    sums = batches.groupBy(*parts, bucket).agg(F.sum("n").alias("held"))
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(in_order("bucket")), F.lit(0)))
    here = sums.where((F.col("before") < n) & (F.col("before") + F.col("held") >= n)).select(*parts, "bucket", "before")
    inside = batches.withColumn("bucket", bucket).join(here, [*parts, "bucket"])
    inside = inside.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(in_order("batch_id")), F.lit(0)))
    inside = inside.where((F.col("before") < n) & (F.col("before") + F.col("n") >= n))
    left = (F.lit(n) - F.col("before")).cast("int")
    return inside.select(*parts, F.col("batch_id").alias("cut_batch"), (F.col("first") + left - 1).alias("cut_index"), left.alias("cut_left"))


def files_in_time(directory: DataFrame, parts: list[str] = ["shard_id"]) -> DataFrame:  # noqa: B006
    """A row per file with the least and the greatest publish time in it."""
    return directory.groupBy(*parts, "file").agg(F.min("publish_time").alias("oldest"), F.max("publish_time").alias("newest"), F.sum("n_records").alias("n_records"))
