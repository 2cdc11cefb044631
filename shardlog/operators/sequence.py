"""Gapless positions and running sums that no single task has to compute alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.session import store

CHUNK = "_chunk"
PLACE = "_place"
# Rows of a chunk: 2^20, whatever the size of a partition.
CHUNK_BITS = 20


def lay_out(
    df: DataFrame, parts: list[str], order: list[str], name: str = "layout", summary: list[Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sort ``df`` by ``parts + order`` over the cluster and write it down.

    Returns the written table, with the sorted run each row fell into (``_chunk``,
    at most 2^20 rows) and its place in the order (``_place``), and one summary row
    per (parts, chunk): rows in it, first place, rows of the same parts before it
    and its number in the part from 0 (``_seq``), with the aggregates in ``summary``.

    ``order`` must be unique within ``parts``. Range partitioning cuts a part of
    any size into equal ranges, so one hot shard is no hot task. Partition numbers
    depend on the sampled cut points; hence the written table.
    """
    keys = [*parts, *order]
    runs = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(PLACE, F.monotonically_increasing_id())
        # The id counts rows within a partition from the partition's own base.
        .withColumn(CHUNK, F.shiftright(PLACE, CHUNK_BITS))
    )
    table = store(runs, name)
    # Rows here: chunks + parts, as every chunk is one range of the sort order.
    in_order = W.partitionBy(*parts).orderBy(CHUNK)
    chunks = (
        table.groupBy(*parts, CHUNK)
        .agg(F.count("*").alias("_rows"), F.min(PLACE).alias("_first"), *(summary or []))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_seq", (F.row_number().over(in_order) - 1).cast("bigint"))
    )
    return table, store(chunks, f"{name}-chunks")


def number_rows(table: DataFrame, chunks: DataFrame, parts: list[str], out: str = "rn") -> DataFrame:
    """1-based position of each row of a laid-out table within its part."""
    return (
        table.join(chunks.select(*parts, CHUNK, "_first", "_before"), [*parts, CHUNK])
        .withColumn(out, F.col("_before") + F.col(PLACE) - F.col("_first") + 1)
        .drop("_first", "_before", PLACE)
    )


def with_position(df: DataFrame, parts: list[str], order: list[str], out: str = "rn") -> DataFrame:
    """``row_number() over (partition by parts order by order)`` without one task per part."""
    table, chunks = lay_out(df, parts, order)
    return number_rows(table, chunks, parts, out).drop(CHUNK)


def running_peak(events: DataFrame, parts: list[str], ts: str, delta: str, slice_: str = "minute") -> DataFrame:
    """Highest running sum of +1/-1 steps reached in each time slice.

    Steps at the same instant count down first, then up. Instants are added up
    before anything is shuffled by part, slices give each other their totals, and
    the running sum inside a slice is bounded by its number of instants.
    """
    slot = F.date_trunc(slice_, F.col(ts)).cast("timestamp_ntz")
    instants = events.groupBy(*parts, slot.alias(slice_), ts).agg(
        F.sum(F.when(F.col(delta) > 0, F.col(delta)).otherwise(0)).alias("_up"),
        F.sum(F.when(F.col(delta) < 0, -F.col(delta)).otherwise(0)).alias("_down"),
    )
    inside = W.partitionBy(*parts, slice_).orderBy(ts).rowsBetween(W.unboundedPreceding, 0)
    step = F.col("_up") - F.col("_down")
    walked = instants.withColumn("_level", F.sum(step).over(inside))
    # Highest level seen at an instant: after the first step down, or after all steps.
    peak = F.greatest(
        F.col("_level"),
        F.when(F.col("_down") > 0, F.col("_level") - step - 1),
    )
    slices = walked.groupBy(*parts, slice_).agg(F.max(peak).alias("_peak"), F.sum(step).alias("_net"))
    earlier = W.partitionBy(*parts).orderBy(slice_).rowsBetween(W.unboundedPreceding, -1)
    return slices.select(
        *parts, slice_,
        (F.coalesce(F.sum("_net").over(earlier), F.lit(0)) + F.col("_peak")).alias("peak"),
    )
