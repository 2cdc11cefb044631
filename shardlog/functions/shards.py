"""Key hashing and the split of the 128-bit hash space into shards."""

from __future__ import annotations

import hashlib
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlog.model import ERROR_NO_SHARD, check_positive

HASH_SPACE = 1 << 128
PREFIX_DIGITS = 4
CASES_LIMIT = 64
BROADCAST_SHARDS_LIMIT = 50_000


def hash_key(key: Column) -> Column:
    """md5 of the key's bytes: 32 hex digits, which sort as the number does."""
    return F.md5(key.cast("binary"))


def shard_bounds(count: int) -> list[tuple[int, str, str]]:
    """(shard_id, start_key, end_key) of an even split; ids start at 1."""
    check_positive("shard_count", count)
    starts = [HASH_SPACE * i // count for i in range(count)] + [HASH_SPACE]
    return [(i + 1, f"{starts[i]:032x}", f"{starts[i + 1] - 1:032x}") for i in range(count)]


def shard_of(key: str, bounds: list[tuple[int, str, str]]) -> int | None:
    """The shard of one literal key, for partition pruning in key reads."""
    ordered = sorted((start, shard) for shard, start, _ in bounds)
    at = bisect_right([s for s, _ in ordered], hashlib.md5(key.encode()).hexdigest())
    return ordered[at - 1][1] if at else None


def shards_frame(spark: SparkSession, bounds: list[tuple[int, str, str]], stream: str = "events") -> DataFrame:
    return spark.createDataFrame(
        [(stream, *b) for b in bounds],
        "stream_name string, shard_id bigint, start_key string, end_key string",
    )


def shard_by_cases(hashed: Column, bounds: list[tuple[int, str, str]]) -> Column:
    """Greatest start key not above the hash, as one compiled expression, no join.

    The end key plays no part. Null when the hash lies below every start key.
    """
    ordered = sorted(((start, shard) for shard, start, _ in bounds), reverse=True)
    found = F.when(hashed >= ordered[0][0], F.lit(ordered[0][1]).cast("bigint"))
    for start, shard in ordered[1:]:
        found = found.when(hashed >= start, F.lit(shard).cast("bigint"))
    return found


def split_unassigned(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with a shard, and those whose hash lies below every shard, with
    ``error``. Batching numbers records within shards and takes only the former."""
    lost = F.col("shard_id").isNull()
    return df.where(~lost), df.where(lost).withColumn("error", F.lit(ERROR_NO_SHARD))


def prefix_table(spark: SparkSession, bounds: list[tuple[int, str, str]]) -> DataFrame:
    """One row per (shard, leading hex digits of the hashes it owns).

    Each shard reaches up to the next start, so gaps fall to the shard before
    them. At most 16^4 rows plus one per shard, whatever the number of records.
    """
    ordered = sorted((start, shard) for shard, start, _ in bounds)
    starts = [int(s or "0", 16) for s, _ in ordered] + [HASH_SPACE]  # an empty start is 0
    shift = 128 - 4 * PREFIX_DIGITS
    rows = [
        (shard, start, f"{starts[i + 1] - 1:032x}", starts[i] >> shift, (starts[i + 1] - 1) >> shift)
        for i, (start, shard) in enumerate(ordered)
        if starts[i + 1] > starts[i]
    ]
    frame = spark.createDataFrame(rows, "shard_id bigint, lo string, hi string, p0 bigint, p1 bigint")
    spread = frame.select("shard_id", "lo", "hi", F.explode(F.sequence("p0", "p1")).alias("p"))
    return spread.select("shard_id", "lo", "hi", F.lpad(F.lower(F.hex("p")), PREFIX_DIGITS, "0").alias("prefix"))


def assign_shards(df: DataFrame, bounds: list[tuple[int, str, str]], hash_col: str = "hash_key", form: str = "auto") -> DataFrame:
    """Add ``shard_id`` by floor lookup of ``hash_col``; null when no shard fits."""
    if form == "cases" or (form == "auto" and len(bounds) <= CASES_LIMIT):
        return df.withColumn("shard_id", shard_by_cases(F.col(hash_col), bounds))
    table = prefix_table(df.sparkSession, bounds)
    if len(bounds) <= BROADCAST_SHARDS_LIMIT:  # so at most 16^4 + 50,000 rows
        table = F.broadcast(table)
    keyed = df.withColumn("prefix", F.substring(hash_col, 1, PREFIX_DIGITS))
    return keyed.join(
        table,
        (keyed["prefix"] == table["prefix"]) & (F.col(hash_col) >= F.col("lo")) & (F.col(hash_col) <= F.col("hi")),
        "left",
    ).drop("prefix", "lo", "hi")
