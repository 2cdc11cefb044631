"""Record ids: text form, parsing and order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format of a record id: shard-batch-index, all decimal.
ID_PATTERN = r"^(\d+)-(\d+)-(\d+)$"


def record_id_text() -> Column:
    return F.concat_ws("-", "shard_id", "batch_id", "batch_index")


def record_position() -> Column:
    """Order of records: by batch, then index. The shard plays no part."""
    return F.struct("batch_id", "batch_index")


def parse_record_id(text: Column) -> Column:
    """Struct (shard_id, batch_id, batch_index), or null when malformed, which a
    number is too that its type cannot hold."""
    part = lambda i, t: F.regexp_extract(text, ID_PATTERN, i).try_cast(t)
    fits = part(1, "bigint").isNotNull() & part(2, "bigint").isNotNull() & part(3, "int").isNotNull()
    return F.when(
        text.rlike(ID_PATTERN) & fits,
        F.struct(
            part(1, "bigint").alias("shard_id"),
            part(2, "bigint").alias("batch_id"),
            part(3, "int").alias("batch_index"),
        ),
    )
