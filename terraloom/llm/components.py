"""Connected components of a graph of links, by alternating star contractions.

Links stay distributed: every round is joins and aggregates over link tables, written to the
shared checkpoint folder. A node with very many links is a skewed join key whose sides are both
plain exchanges, which adaptive execution splits; the minima combine before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.session import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, root)`` for every node of a link; the root is the smallest node reachable.

    Links with a null end and loops are ignored; repeated links do no harm. Each round links every
    node's larger neighbours to its smallest neighbour, then every node's smaller neighbours and
    itself to the smallest of them, until no link changes.
    """
    edges = materialise(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct(), "links")
    state = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = materialise(both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m")), "least")
        large = materialise(
            both.join(least, "v").where(F.col("u") > F.col("v")).select(F.col("u").alias("v"), F.col("m").alias("u"))
            .where("u <> v").distinct(), "links")
        least = materialise(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        edges = materialise(
            large.join(least, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"), F.col("m").alias("u"))
            .where("u <> v").distinct(), "links")
        now = _fingerprint(edges)
        if now == state:
            # Every node now links to its root alone.
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        state = now


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)
