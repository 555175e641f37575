"""Equi-joins. No side is broadcast by hint: Spark broadcasts what it measures to be small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.session import materialise


def rows_for_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def outer_on(left: DataFrame, right: DataFrame, on: Sequence[str], many: str | None = None) -> DataFrame:
    """Full outer join on equal key columns; null keys match nothing and are kept.

    ``many="right"`` says that ``left`` has one row per key while a key of ``right`` may have
    very many. The join then runs as a left join from ``right``, whose hot keys adaptive
    execution can split (it cannot in a full outer join), plus the keys found in ``left`` only.
    Both use ``left``, which is therefore written once instead of being computed twice.
    """
    on = list(on)
    if many is None:
        return left.join(right, on, "full_outer")
    left = materialise(left, "outer")
    lcols = [c for c in left.columns if c not in on]
    rcols = [c for c in right.columns if c not in on]
    matched = right.join(left, on, "left").select(*on, *lcols, *rcols)
    alone = left.join(right.select(*on).distinct(), on, "left_anti").select(
        *on, *lcols, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rcols])
    return matched.unionByName(alone)


def outer_coalesced(left: DataFrame, right: DataFrame, on: Sequence[str],
                    fallback: Sequence[str], many: str | None = None) -> DataFrame:
    """Full outer join in which shared columns take the left value, else the right one."""
    moved = {c: f"_right_{c}" for c in fallback}
    joined = outer_on(left, right.withColumnsRenamed(moved), on, many)
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(m)) for c, m in moved.items()}).drop(*moved.values())


def join_dimension(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a dimension, its key column once."""
    return df.join(dim, [on] if isinstance(on, str) else list(on), "left")


def attach_to_polygons(polys: DataFrame, df: DataFrame, poly_key: str, key: str) -> DataFrame:
    """Every polygon, with the matching rows where there are any; keys compare as text."""
    rows = df.withColumn("_key", F.col(key).cast("string"))
    return polys.join(rows, polys[poly_key].cast("string") == rows["_key"], "left").drop("_key")


def with_geometry(dim: DataFrame, polys: DataFrame, on: str = "municipality_id") -> DataFrame:
    """Dimension rows that have a geometry; estimates know nothing of the rings, so they are never broadcast."""
    return dim.join(polys.hint("merge"), on, "inner")


def join_embeddings(df: DataFrame, vectors: DataFrame, on: str = "municipality_id") -> DataFrame:
    return df.join(vectors, on, "inner")


def exclude_known(candidates: DataFrame, known: DataFrame, on: Sequence[str] = ("s", "p", "o")) -> DataFrame:
    """Candidate triples that are not known to be true."""
    return candidates.join(known.select(*on), list(on), "left_anti")


def derive_parent_edges(edges: DataFrame, parents: DataFrame, child: str = "id",
                        neighbor: str = "neighbor_id", parent: str = "parent") -> DataFrame:
    """Adjacency of parents, both directions, from edges between their children.

    ``parents`` holds ``child, parent`` with one row per child. Pairs are made distinct before
    they are mirrored, so the shuffle carries parent pairs and not child edges. There are as many
    parents as children, so neither they nor the edges are ever broadcast.
    """
    left = parents.select(F.col(child), F.col(parent).alias("a"))
    right = parents.select(F.col(child).alias(neighbor), F.col(parent).alias("b"))
    pairs = (edges.select(child, neighbor).join(left.hint("merge"), child).join(right.hint("merge"), neighbor)
             .filter(F.col("a") != F.col("b"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = F.array(F.struct(F.col("a").alias(parent), F.col("b").alias("neighbor")),
                   F.struct(F.col("b").alias(parent), F.col("a").alias("neighbor")))
    return pairs.select(F.inline(both))


def mapping_frame(spark, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A fixed dictionary as a two-column table."""
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")
