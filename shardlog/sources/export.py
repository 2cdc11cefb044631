"""Copying records to and from other formats and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_FORMATS = ("parquet", "orc", "json", "csv")
# Text formats would otherwise cut times to milliseconds.
TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def export_records(records: DataFrame, target: str, fmt: str = "parquet", mode: str = "errorifexists", **options: str) -> None:
    """Write records out. Bytes become base64 text where the format has no bytes.

    ``fmt="jdbc"`` passes url and the rest as options to Spark's own writer.
    """
    if fmt == "jdbc":
        records.write.format("jdbc").options(dbtable=target, **options).mode(mode).save()
        return
    if fmt not in FILE_FORMATS:
        raise ValueError(f"format must be one of {FILE_FORMATS} or jdbc, got {fmt!r}")
    if fmt in ("json", "csv"):
        options = {**TEXT_TIMES, **options}
        records = records.select(
            *[F.base64(f.name).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name) for f in records.schema]
        )
    records.write.format(fmt).options(**options).mode(mode).save(target)


def import_records(spark: SparkSession, source: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """Read records written by ``export_records`` back into their schema."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=source, **options).load()
    if fmt not in ("json", "csv"):
        return spark.read.schema(schema).format(fmt).options(**options).load(source)
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType) for f in schema])
    rows = spark.read.schema(text).format(fmt).options(**{**TEXT_TIMES, **options}).load(source)
    return rows.select(
        *[F.unbase64(f.name).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name) for f in schema]
    )
