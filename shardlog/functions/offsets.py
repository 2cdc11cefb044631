"""Offsets as predicates over the columns of a record log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardlog.model import Offset


def _time(offset: Offset) -> Column:
    return F.lit(offset.at.isoformat(sep=" ")).cast("timestamp_ntz")


def _at_or_after(batch_id: int, batch_index: int) -> Column:
    # The plain bound on batch_id is implied; it is there to reach the scan.
    b, i = F.col("batch_id"), F.col("batch_index")
    return (b >= batch_id) & ((b > batch_id) | (i >= batch_index))


def _at_or_before(batch_id: int, batch_index: int) -> Column:
    b, i = F.col("batch_id"), F.col("batch_index")
    return (b <= batch_id) & ((b < batch_id) | (i <= batch_index))


def from_predicate(offset: Offset) -> Column:
    """Lower bound, inclusive. ``latest`` selects nothing of a bounded table;
    for a table that grows after the read began use ``operators.subscriptions.after_tail``."""
    if offset.kind in ("earliest", "empty"):
        return F.lit(True)
    if offset.kind == "latest":
        return F.lit(False)
    if offset.kind == "record":
        return _at_or_after(offset.batch_id, offset.batch_index)
    return F.col("publish_time") >= _time(offset)


def until_predicate(offset: Offset) -> Column:
    """Upper bound, inclusive."""
    if offset.kind in ("latest", "empty"):
        return F.lit(True)
    if offset.kind == "earliest":
        return F.lit(False)
    if offset.kind == "record":
        return _at_or_before(offset.batch_id, offset.batch_index)
    return F.col("publish_time") <= _time(offset)


def trim_predicate(offset: Offset) -> Column:
    """Records a stream trim removes: up to and including the offset."""
    if offset.kind == "empty":
        raise ValueError("a trim needs an offset; latest removes all records")
    if offset.kind == "earliest":
        return F.lit(False)
    if offset.kind == "latest":
        return F.lit(True)
    return until_predicate(offset)
