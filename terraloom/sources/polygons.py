"""Polygon tables: rings of points from well-known text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_polygons(df: DataFrame, wkt: str = "wkt") -> DataFrame:
    """Replace a POLYGON or MULTIPOLYGON text by ``rings`` (arrays of x, y); others are dropped.

    All rings, outer or inner, are listed alike: the interior follows from the even-odd rule.
    """
    point = lambda t: F.split(F.trim(t), r"\s+")
    ring = lambda text: F.transform(F.split(text, ","), lambda t: F.struct(
        F.get(point(t), F.lit(0)).try_cast("double").alias("x"),
        F.get(point(t), F.lit(1)).try_cast("double").alias("y")))
    texts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1)
    keep = [c for c in df.columns if c != wkt]
    return (df.filter(F.upper(F.trim(wkt)).rlike(r"^(MULTI)?POLYGON"))
            .select(*keep, F.transform(texts, ring).alias("rings"))
            .filter(F.size("rings") > 0))


def read_polygons(spark: SparkSession, path: str, fmt: str = "parquet", wkt: str = "wkt") -> DataFrame:
    return parse_polygons(spark.read.format(fmt).load(path), wkt)
