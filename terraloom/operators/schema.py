"""Shape of tables: conforming, renaming, dropping, completing and selecting columns."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom.functions.columns import lookup, nanos_to_ts


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order: cast where types differ, null where absent.

    A 64-bit integer that must become a timestamp is read as epoch nanoseconds; any
    other value that cannot be cast becomes null.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        col, kind = F.col(f"`{field.name}`"), have[field.name]
        if kind == field.dataType:
            return col
        if isinstance(kind, T.LongType) and isinstance(field.dataType, T.TimestampType):
            return nanos_to_ts(col).alias(field.name)
        return col.try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Mapped columns under their new names, in mapping order; absent ones are warned about."""
    absent = [old for old in mapping if old not in df.columns]
    if absent:
        warnings.warn(f"columns to rename are absent: {absent}", stacklevel=2)
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in mapping.items() if o in df.columns])


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o in df.columns})


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Those of ``cols`` that exist, in the order of ``cols``; none at all is an error."""
    found = [c for c in cols if c in df.columns]
    if not found:
        raise ValueError(f"none of {list(cols)} is a column")
    return df.select(*[F.col(f"`{c}`") for c in found])


def map_column(df: DataFrame, col: str, mapping: Mapping[str, object], out: str | None = None,
               keep_unlisted: bool = False) -> DataFrame:
    """Translate a column by a fixed dictionary; unlisted values are null or kept."""
    default = F.col(col) if keep_unlisted else None
    return df.withColumn(out or col, lookup(col, mapping, default))


def add_null_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed null columns for the fields of ``schema`` that ``df`` lacks, appended in order."""
    return df.withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns
    })


def ensure_columns(df: DataFrame, names: Sequence[str], kind: str = "double") -> DataFrame:
    """Null columns of one type for the names that a pivot did not produce."""
    return df.withColumns({n: F.lit(None).cast(kind) for n in names if n not in df.columns})


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that names the missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def empty_like(spark, schema: T.StructType) -> DataFrame:
    """No rows under a fixed schema, for a source that is not available."""
    return spark.createDataFrame([], schema)
