"""Tables: scans with a physical schema, overwriting sinks and read-back profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom.session import read_options
from terraloom.sources.versions import read_version, write_version


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a given schema replaces the one in the files (nanosecond times as bigint)."""
    reader = spark.read.options(**read_options())
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table by its format; ``versioned`` reads the latest version (see :mod:`terraloom.sources.versions`)."""
    if fmt == "versioned":
        return read_version(spark, path)
    return spark.read.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                columns: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> None:
    """Write a table, replacing rows and schema; ``columns`` fixes the order of those present.

    The format ``versioned`` publishes a new version, so the rows before stay whole and readable.
    """
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    if fmt == "versioned":
        write_version(df if mode != "append" else read_version(df.sparkSession, path).unionByName(df), path, partition_by)
        return
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def profile_table(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows and, per column, its type, non-null count and extremes as text, in one pass."""
    plain = [f for f in df.schema.fields
             if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    summary = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("rows"), F.count(F.col(f"`{f.name}`")).alias("present"),
            F.min(f"`{f.name}`").cast("string").alias("least"),
            F.max(f"`{f.name}`").cast("string").alias("greatest")).alias(f"c{i}")
        for i, f in enumerate(plain)]
    return df.agg(*summary).select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(plain))])))


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows a reader would look at; no order is implied."""
    return df.limit(n)
