"""Dense statistical cubes: a flat row-major value list over the product of dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A cube row has: dims array<string>, codes array<array<string>> (one list per dimension),
# labels array<map<string,string>>, raw array<string> (the values as text).


def _product(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(1).cast("long"), lambda acc, n: acc * n)


def _sizes() -> Column:
    return F.transform("codes", lambda c: F.size(c).cast("long"))


def flatten_cube(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """One row per cell: ``<DIM>_CODE, <DIM>_LABEL`` of each dimension and ``VALUE``.

    The position of a value gives its code in each dimension by mixed-radix arithmetic, so
    the product of the dimensions is never built. Values beyond the product are ignored, a
    label defaults to its code, and a value that is no number is null. Other columns of the
    cube (``keep``) pass through.
    """
    keep = [c for c in df.columns if c not in ("dims", "codes", "labels", "raw")]
    return _cells(_strided(df, keep, "raw").select(*keep, *_AXES, F.posexplode("raw").alias("pos", "text")), dims, keep)


_AXES = ("dims", "codes", "labels", "sizes", "strides", "total")


def _strided(cubes: DataFrame, keep: Sequence[str], *more: str) -> DataFrame:
    sized = cubes.filter(F.size("dims") > 0).select(*keep, "dims", "codes", "labels", *more, _sizes().alias("sizes"))
    return sized.withColumn("total", _product(F.col("sizes"))).withColumn(
        "strides", F.transform(F.sequence(F.lit(1), F.size("sizes")), lambda k: _product(
            F.slice("sizes", k + 1, F.size("sizes")))))


def _cells(placed: DataFrame, dims: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Codes, labels and number of each value ``text`` at its place ``pos`` of a cube."""
    cells = placed.filter(F.col("pos") < F.col("total"))
    out = []
    for d in dims:
        at = F.array_position("dims", F.lit(d)).cast("int")
        index = F.floor(F.col("pos") / F.element_at("strides", at)) % F.element_at("sizes", at)
        code = F.when(at > 0, F.get(F.element_at("codes", at), index.cast("int")))
        label = F.when(at > 0, F.try_element_at(F.element_at("labels", at), code))
        out += [code.alias(f"{d}_CODE"), F.coalesce(label, code).alias(f"{d}_LABEL")]
    return cells.select(*keep, *out, F.col("text").try_cast("double").alias("VALUE"))


def flatten_cube_values(cubes: DataFrame, values: DataFrame, dims: Sequence[str], key: str = "path") -> DataFrame:
    """As :func:`flatten_cube` for cubes whose values are rows ``key, pos, text`` of their own.

    The axes of a cube are joined to its values; no task needs a whole cube.
    """
    return _cells(values.join(_strided(cubes, [key]), key), dims, [key])


def validate_cube_values(cubes: DataFrame, key: str = "path") -> DataFrame:
    """As :func:`validate_cube` for cubes with the number of their values in ``found``."""
    return _agreement(cubes, [key], _product(_sizes()), F.col("found"))


def validate_cube(df: DataFrame) -> DataFrame:
    """Cells expected from the dimensions, values found, and whether they agree."""
    keep = [c for c in df.columns if c not in ("dims", "codes", "labels", "raw")]
    expected = _product(_sizes())
    found = F.size("raw").cast("long")
    return _agreement(df, keep, expected, found)


def _agreement(df: DataFrame, keep: Sequence[str], expected: Column, found: Column) -> DataFrame:
    return df.select(*keep, expected.alias("expected"), found.alias("found"),
                     F.least(expected, found).alias("flattened"), (expected == found).alias("complete"))
