"""Subscriptions whose position is stored beside the log, so that they survive a restart."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardlog.operators.subscriptions import after_tail
from shardlog.sources.directory import read_directory, tails

_CURSOR = "shard_id bigint, batch_id bigint, batch_index int"


def _home(path: str, name: str) -> str:
    return f"{path}/_subscriptions/{quote(name, safe='')}"


def create_subscription(spark: SparkSession, path: str, name: str, start: str = "latest") -> None:
    """Store where a new subscription to the log at ``path`` begins. ``latest`` is behind
    the tail that each shard has now, resolved once and from the directory alone: what is
    appended later comes, however late it is fetched. A name can be taken once."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be earliest or latest, got {start!r}")
    at = tails(read_directory(spark, path)) if start == "latest" else spark.createDataFrame([], _CURSOR)
    at.write.parquet(f"{_home(path, name)}/cursor=0")


def cursor(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The last record of each shard that the subscription is done with."""
    return _at(spark, path, name)[1]


def _at(spark: SparkSession, path: str, name: str) -> tuple[int, DataFrame]:
    home = _home(path, name)
    try:
        stored = spark.read.schema(f"{_CURSOR}, cursor int").option("basePath", home).parquet(home)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"no subscription {name!r}") from None
    # A cursor without rows is one at the start, which only the first can be.
    number = stored.agg(F.max("cursor")).first()[0] or 0
    return number, stored.where(F.col("cursor") == number).drop("cursor")


def fetch(spark: SparkSession, path: str, name: str, schema: StructType) -> DataFrame:
    """The records behind the subscription's stored position. Only the files in which
    the directory lists such records are read."""
    at = cursor(spark, path, name).select("shard_id", F.struct("batch_id", "batch_index").alias("_tail"))
    last = F.struct("batch_id", F.col("last_index").alias("batch_index"))
    listed = read_directory(spark, path).join(at, "shard_id", "left").where(F.col("_tail").isNull() | (last > F.col("_tail")))
    files = [r["file"] for r in listed.select("file").distinct().toLocalIterator()]  # a row per file, as in Spark's own listing
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*files).select(*schema.names)
    return after_tail(rows, cursor(spark, path, name))


def advance(spark: SparkSession, path: str, name: str, done: DataFrame) -> None:
    """Move the stored position of each shard to the last record of ``done``, never back.
    The new position is a table of its own: one that broke off leaves the old one."""
    number, at = _at(spark, path, name)
    moved = at.unionByName(done.select("shard_id", "batch_id", F.col("batch_index").cast("int")))
    last = moved.groupBy("shard_id").agg(F.max(F.struct("batch_id", "batch_index")).alias("t"))
    last.select("shard_id", "t.*").write.mode("overwrite").parquet(f"{_home(path, name)}/cursor={number + 1}")
