"""What the operators share: text columns, Arrow batches of bounded size, names that cannot clash."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 4096
BATCH_BYTES = 16 << 20


def text_of(text: str = "text") -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keyed(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Only ``doc_id`` and ``text``, under these names; all other columns are left behind."""
    return df.select(F.col(quoted(id_column)).alias("doc_id"), text_of(text).alias("text"))


def packed_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct ``row`` beside computed columns, so that no name can clash."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
                     *[c.alias(name) for name, c in columns.items()])


def unpacked_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows put away by :func:`packed_rows`, with their own columns only."""
    return df.select(*[F.col("row." + quoted(c)).alias(c) for c in columns])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]], schema: str, **kinds: pa.DataType) -> DataFrame:
    """``mapInArrow`` over a generator of row tuples, sent in batches of bounded rows and bytes.

    ``kinds`` are the Arrow types of the columns, in the order of ``schema``.
    """
    arrow = pa.schema([pa.field(k, t) for k, t in kinds.items()])
    rows_bound, bytes_bound = BATCH_ROWS, BATCH_BYTES

    def run(batches):
        held, size = [], 0
        for row in fn(batches):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(held) >= rows_bound or size >= bytes_bound:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def crc_bucket(id_column: Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n``; null ids give null."""
    return F.crc32(id_column.cast("string").cast("binary")) % n


def kept_in_worker(key, make: Callable):
    """An object that a Python worker makes once and keeps between its tasks, such as a cache.

    Functions travel by value, so module variables would start afresh with every task.
    """
    home = sys.modules.setdefault("_terraloom_worker", types.ModuleType("_terraloom_worker")).__dict__
    if key not in home:
        home[key] = make()
    return home[key]
