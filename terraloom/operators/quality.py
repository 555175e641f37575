"""Row rules: conditions, per-key ranges, and one-pass cleaning with a report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """A named condition; a row passes only if it is true (null fails)."""

    name: str
    condition: Column


def not_null(cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def in_range(c: Column | str, lo, hi) -> Column:
    """Inclusive range; null fails, and so does NaN, which sorts above every number."""
    return (F.col(c) if isinstance(c, str) else c).between(lo, hi)


def null_or_range(c: str, lo, hi) -> Column:
    return F.col(c).isNull() | F.col(c).between(lo, hi)


def text_int_in_range(c: str, lo: int, hi: int) -> Column:
    """Range of a text column read as an integer; unreadable text fails."""
    return F.col(c).try_cast("int").between(lo, hi)


def length_is(c: str, n: int) -> Column:
    return F.length(F.col(c)) == n


def greater_than(c: str, lo) -> Column:
    """Exclusive lower bound; NaN passes, as it sorts above every number."""
    return F.col(c) > lo


def where_eq(df: DataFrame, c: str, value) -> DataFrame:
    return df.filter(F.col(c) == value)


def where_in(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(c).isin(list(values)))


def dropna(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows complete in ``subset``; NaN counts as missing there."""
    return df.dropna(subset=list(subset))


def keyed_range(key: str, value: str, ranges: Mapping[str, tuple[float, float]]) -> Column:
    """Per-key inclusive range: an unlisted (or null) key passes, a listed one with null fails.

    The table of ranges is a fixed dictionary, so it is a condition and not a join; it is
    grouped by equal ranges to keep the expression short.
    """
    by_range: dict[tuple[float, float], list[str]] = {}
    for code, bounds in ranges.items():
        by_range.setdefault(bounds, []).append(code)
    cases = None
    for (lo, hi), codes in by_range.items():
        test = F.coalesce(F.col(value).between(lo, hi), F.lit(False))
        member = F.col(key).isin(codes)
        cases = F.when(member, test) if cases is None else cases.when(member, test)
    return F.lit(True) if cases is None else cases.otherwise(F.lit(True))


def keyed_ranges(df: DataFrame, key: str, value: str, ranges) -> DataFrame:
    return df.filter(keyed_range(key, value, ranges))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the rows before, after and removed by each rule in order.

    The report is one global aggregate over the input, whatever the number of rules: a row
    is charged to the first rule it fails.
    """
    clean = df.filter(reduce(and_, [r.condition for r in rules]))
    passes = [F.coalesce(r.condition, F.lit(False)) for r in rules]
    first_failed = F.coalesce(*[F.when(~ok, F.lit(i)) for i, ok in enumerate(passes)])
    tallies = df.select(first_failed.alias("failed")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("failed") == i).alias(f"r{i}") for i in range(len(rules))],
    )
    lines, before = [], F.col("total")
    for i, rule in enumerate(rules):
        after = before - F.col(f"r{i}")
        lines.append(F.struct(
            F.lit(i + 1).alias("step"), F.lit(rule.name).alias("rule"),
            before.alias("rows_before"), after.alias("rows_after"),
            F.col(f"r{i}").alias("rows_removed"),
        ))
        before = after
    return clean, tallies.select(F.inline(F.array(*lines)))


def null_nan_count(df: DataFrame, col: str) -> DataFrame:
    """Number of null and NaN values of a numeric column."""
    return df.agg(F.count_if(F.col(col).isNull() | F.isnan(col)).alias("null_or_nan"))


def count_imputed(df: DataFrame, value: str, imputed: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(value).isNull() & F.col(imputed).isNotNull()).alias("imputed"))


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def valid_years(df: DataFrame, year: str, measures: Sequence[str]) -> DataFrame:
    """Years in which some row has every measure, ascending."""
    return df.filter(not_null(measures)).select(year).distinct().orderBy(year)


def entity_triples(triples: DataFrame) -> DataFrame:
    """Triples that link two URIs."""
    return triples.filter(F.col("o_kind") == "uri").select("s", "p", "o")
