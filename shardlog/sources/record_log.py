"""Writing and reading record logs: tables partitioned by shard, sorted by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.functions.offsets import from_predicate, until_predicate
from shardlog.functions.shards import shard_of
from shardlog.model import ERROR_NO_SHARD, ERROR_TOO_MANY_SHARDS, Offset
from shardlog.session import store
from shardlog.sources.directory import batches_between, cut_points

BROADCAST_BATCHES_LIMIT = 100_000
# Records of a limit that each task may sort out and send to one; more are cut by counts.
SORTED_LIMIT = 10_000


def write_log(records: DataFrame, path: str, parts: list[str] = ["shard_id"], mode: str = "append") -> None:  # noqa: B006
    """Append numbered records to a log, one directory per shard."""
    records.sortWithinPartitions(*parts, "batch_id", "batch_index").write.mode(mode).partitionBy(*parts).parquet(path)


def append_results(assigned: DataFrame, failed_batches: DataFrame | None = None, parts: list[str] = ["shard_id"]) -> DataFrame:  # noqa: B006
    """Outcome of each record: its id, or the error its whole batch met.

    ``failed_batches`` holds parts, batch_id and ``error``. A record whose key no
    shard covers has an error of its own.
    """
    if failed_batches is None:
        out = assigned.withColumn("error", F.lit(None).cast("string"))
    else:
        out = assigned.join(failed_batches.select(*parts, "batch_id", "error"), [*parts, "batch_id"], "left")
    return out.withColumn("error", F.when(F.col("shard_id").isNull(), ERROR_NO_SHARD).otherwise(F.col("error")))


def read_stream(
    log: DataFrame,
    stream: str | None = None,
    start: Offset = Offset.earliest(),
    until: Offset = Offset.empty(),
    max_batches: int = 0,
    directory: DataFrame | None = None,
) -> DataFrame:
    """Records of all shards between two offsets; at most ``max_batches`` batches,
    0 for no limit. Order is kept inside a shard by the id columns only. With the log's
    ``directory`` the batches are chosen there, and not from all records."""
    rows = log if stream is None else log.where(F.col("stream_name") == stream)
    rows = rows.where(from_predicate(start) & until_predicate(until))
    if directory is not None and stream is not None:
        directory = directory.where(F.col("stream_name") == stream)
    among = rows if directory is None else batches_between(directory, start, until)
    return first_batches(rows, max_batches, among) if max_batches > 0 else rows


def first_batches(rows: DataFrame, n: int, among: DataFrame | None = None) -> DataFrame:
    """Records of the first ``n`` batches by (batch, shard), of those ``among``."""
    among = rows if among is None else among
    chosen = among.select("batch_id", "shard_id").distinct().orderBy("batch_id", "shard_id").limit(n)
    if n <= BROADCAST_BATCHES_LIMIT:  # n rows of two numbers
        chosen = F.broadcast(chosen)
    return rows.join(chosen, ["batch_id", "shard_id"], "left_semi")


def read_shard(
    log: DataFrame, shard_id: int, start: Offset = Offset.earliest(), until: Offset = Offset.empty(), max_records: int = 1, directory: DataFrame | None = None
) -> DataFrame:
    """The first records of one shard from an offset; one by default, 0 for all.

    With the log's ``directory`` the place of the last one is worked out from the counts
    of batches, and the records are those up to it: bounds for the scan, without a sort
    or a limit, so in no order beyond that of their ids.
    """
    rows = log.where(F.col("shard_id") == shard_id).where(from_predicate(start) & until_predicate(until))
    if max_records <= 0:
        return rows
    if directory is None:
        return rows.orderBy("batch_id", "batch_index").limit(max_records)
    batches = batches_between(directory.where(F.col("shard_id") == shard_id), start, until)
    cut = cut_points(batches, max_records).first()
    return rows if cut is None else rows.where(until_predicate(Offset.record(cut["cut_batch"], cut["cut_index"])))


def read_shard_batches(
    log: DataFrame, shard_id: int, start: Offset = Offset.earliest(), until: Offset = Offset.empty(), max_batches: int = 0
) -> DataFrame:
    """All records of one shard between two offsets, limited by batches."""
    return read_stream(log.where(F.col("shard_id") == shard_id), None, start, until, max_batches)


def read_single_shard(
    log: DataFrame, shards: DataFrame, start: Offset = Offset.earliest(), until: Offset = Offset.empty(), max_batches: int = 0
) -> DataFrame:
    """The same for a stream that must have exactly one shard."""
    found = shards.select("shard_id").limit(2).collect()
    if len(found) != 1:
        raise ValueError(ERROR_TOO_MANY_SHARDS if found else "no shard")
    return read_shard_batches(log, found[0][0], start, until, max_batches)


def read_by_key(
    log: DataFrame,
    key: str,
    bounds: list[tuple[int, str, str]],
    start: Offset = Offset.earliest(),
    until: Offset = Offset.empty(),
    count: int = 0,
) -> DataFrame:
    """The first ``count`` records of a key, 0 for all. The key's shard is given
    to the scan as a literal, so only that shard's files are read. Large counts are cut
    by how many records of the key each batch has, so that no task sorts them all."""
    rows = log.where((F.col("shard_id") == shard_of(key, bounds)) & (F.col("key") == key))
    rows = rows.where(from_predicate(start) & until_predicate(until))
    if count <= 0:
        return rows
    if count <= SORTED_LIMIT:
        return rows.orderBy("batch_id", "batch_index").limit(count)
    batches = rows.groupBy("shard_id", "batch_id").agg(F.lit(0).alias("first"), F.count("*").alias("n"))
    cut = cut_points(batches, count).first()
    if cut is None:
        return rows
    whole, last = rows.where(F.col("batch_id") < cut["cut_batch"]), rows.where(F.col("batch_id") == cut["cut_batch"])
    return whole.unionByName(last.orderBy("batch_index").limit(cut["cut_left"]))


def first_records_per_shard(log: DataFrame, n: int, start: Offset = Offset.earliest(), directory: DataFrame | None = None) -> DataFrame:
    """One read of every shard: at most ``n`` records each. With the log's ``directory``
    the place of each shard's last one is worked out there."""
    rows = log.where(from_predicate(start))
    if directory is None:
        place = F.row_number().over(W.partitionBy("shard_id").orderBy("batch_id", "batch_index"))
        return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
    # A row per shard at most, written so that the join is planned by its true size.
    cuts = store(cut_points(batches_between(directory, start), n).drop("cut_left"), "cuts")
    within = (F.col("batch_id") < F.col("cut_batch")) | ((F.col("batch_id") == F.col("cut_batch")) & (F.col("batch_index") <= F.col("cut_index")))
    return rows.join(cuts, "shard_id", "left").where(F.col("cut_batch").isNull() | within).drop("cut_batch", "cut_index")


def tail_ids(log: DataFrame, parts: list[str] = ["shard_id"]) -> DataFrame:  # noqa: B006
    """Last record id of each shard."""
    return log.groupBy(*parts).agg(F.max(F.struct("batch_id", "batch_index")).alias("t")).select(*parts, "t.batch_id", "t.batch_index")


def shard_profile(records: DataFrame, shards: DataFrame, batch_count: int, n_bytes: str = "n_bytes") -> DataFrame:
    """Records, bytes and batches of every shard, also of empty ones. Records are
    counted before they meet the shard list, so the join is as small as the list."""
    counted = records.groupBy("shard_id").agg(
        F.count("*").alias("records"),
        F.sum(n_bytes).cast("bigint").alias("bytes"),
        F.min("hash_key").alias("first_key"),
        F.max("hash_key").alias("last_key"),
    )
    return (
        shards.join(counted, "shard_id", "left")
        .fillna(0, ["records", "bytes"])
        .withColumn("batches", F.ceil(F.col("records") / batch_count))
        .orderBy("start_key")
    )
