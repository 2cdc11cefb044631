"""Comparing what was produced with what was consumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(produced: DataFrame, consumed: DataFrame, id_cols: list[str]) -> DataFrame:
    """Ids that differ between the two, as multisets: missing (never consumed),
    extra (never produced) or duplicate (consumed more often than produced).

    Both sides are counted in one aggregation, which adds up copies before the
    shuffle: an id repeated any number of times is one row of each task.
    """
    side = lambda df, p, c: df.select(*id_cols, F.lit(p).alias("_p"), F.lit(c).alias("_c"))
    counts = side(produced, 1, 0).unionByName(side(consumed, 0, 1)).groupBy(*id_cols)
    both = counts.agg(F.sum("_p").alias("n_produced"), F.sum("_c").alias("n_consumed"))
    status = (
        F.when(F.col("n_produced") == 0, "extra")
        .when(F.col("n_consumed") < F.col("n_produced"), "missing")
        .when(F.col("n_consumed") > F.col("n_produced"), "duplicate")
    )
    return both.withColumn("status", status).where("status is not null")
