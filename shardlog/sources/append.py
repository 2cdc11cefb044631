"""Appending records to a log: shard, cut into batches, number, write, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.functions.ids import record_id_text
from shardlog.functions.shards import assign_shards, hash_key, split_unassigned
from shardlog.operators.batching import STATE, Rule, cut_batches
from shardlog.sources.directory import commit_path, next_commit, read_directory, record_commit, tails
from shardlog.sources.record_log import append_results, write_log
from shardlog.session import store

SINGLE = Rule(count=1)


def append(
    records: DataFrame,
    path: str,
    bounds: list[tuple[int, str, str]],
    rule: Rule,
    ts: str = "ts",
    order: list[str] = ["event_id"],  # noqa: B006
) -> DataFrame:
    """Append records with ``key`` and ``n_bytes`` to the log at ``path``, in the
    order ``(ts, *order)``, and return each with ``rid`` or ``error``.

    Batch ids go on from the tails in the log's directory, so none is given twice; of
    what is stored, nothing else is read. The records are a commit of their own, listed
    in the directory last: an append that broke off is not in the log, and the next one
    replaces what it left. What is appended at once is flushed at its end, so the first
    record of the next append begins a batch. A log has one writer at a time.
    """
    spark = records.sparkSession
    hashed = records.withColumn("hash_key", hash_key(F.col("key")))
    good, lost = split_unassigned(assign_shards(hashed, bounds))
    directory = read_directory(spark, path)
    number = next_commit(directory)
    none = F.lit(None).cast("bigint")
    # Written, as this commit adds to the directory that it is read from.
    resume = store(
        tails(directory).select(
            "shard_id", *[none.alias(c) for c in STATE], F.col("batch_id").alias("batches"), (F.col("batch_id") * rule.count).alias("records")
        ),
        "tails",
    )
    rows = cut_batches(good, ["shard_id"], ts, order, "n_bytes", rule, resume).records.drop("rn")
    data = commit_path(path, number)
    write_log(rows, data, mode="overwrite")
    written = spark.read.schema(rows.schema).parquet(data)
    record_commit(written, path, number, ts=ts)
    done = append_results(written).withColumn("rid", record_id_text())
    return done.unionByName(lost, allowMissingColumns=True)
