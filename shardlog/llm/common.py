"""What several of the operators share: names, tables and byte-bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROW = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def narrow(df: DataFrame, carry: bool = False, **named: str) -> DataFrame:
    """Only the columns an operator works on, under the operator's own names.

    With ``carry`` the whole input row goes along in one struct, so that input
    columns cannot clash with the operator's own; ``widen`` brings them back.
    """
    own = [col(source).alias(name) for name, source in named.items()]
    return df.select(*own, F.struct(*[col(c) for c in df.columns]).alias(ROW)) if carry else df.select(*own)


def widen(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def pinned(column: Column) -> Column:
    """The same value, worked out once per row.

    Catalyst copies a deterministic expression into the lambdas and filters above it,
    where it would be worked out for every element. It leaves one alone that depends
    on a row number, here in a condition that always holds.
    """
    return F.when(F.monotonically_increasing_id() >= 0, column)


def byte_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of ``column``, or one row.

    A slice is a view: nothing is copied, and a task's memory follows ``limit``
    and its longest text, not the size of an Arrow batch.
    """
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; a null text is empty."""
    return [b"" if t is None else t for t in batch.column(column).cast(pa.binary()).to_pylist()]


def extended(df: DataFrame, added: str, without: tuple[str, ...] = ()) -> StructType:
    """The schema of ``df`` less some columns, with those of a DDL string."""
    new = StructType.fromDDL(added)
    gone = {*without, *new.names}
    return StructType([f for f in df.schema if f.name not in gone] + new.fields)


def map_blocks(
    df: DataFrame, column: str, limit: int, schema: StructType | str, work: Callable[[pa.RecordBatch], pa.RecordBatch]
) -> DataFrame:
    """``work`` on every byte-bounded block of ``df``, where Spark's partitions lie."""

    def run(batches):
        for block in byte_blocks(batches, column, limit):
            yield work(block)

    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Jobs that run inside send at most ``n_bytes`` to Python at a time, or a row.

    By default an Arrow batch has 10,000 rows, which are as many texts on both sides.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shifted_sums(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, and of all: one entry more than values."""
    out = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=out[1:])
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = shifted_sums(counts)[:-1]
    return np.repeat(starts - before, counts) + np.arange(total)
