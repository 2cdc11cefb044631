"""Connected components of a link table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlog.session import store


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (src, dst): root is the smallest
    node of its component.

    Stars grow until each component is one: in turn, every node links its larger and
    then its smaller neighbours to the least node it knows. Both steps are a grouped
    minimum and a join on the same key, so a node with very many links is
    pre-aggregated on one side and split by adaptive execution on the other. The
    number of rounds follows the logarithm of the longest chain.
    """
    edges = store(
        links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        large = _linked(edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), larger=True)
        small = store(_linked(large, larger=False), "stars")
        state = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        edges, before = small, state


def _linked(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours, and itself, linked to the least."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = edges.join(least, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
