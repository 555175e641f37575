"""Registered queries: a Spark function over the given tables and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]


NUDGE = 1e-9


def nudged(sql: str) -> str:
    """``round(x, 6)`` as ``round(x + 1e-9, 6) + 0.0`` throughout, as :func:`round6` does in Spark.

    Many results are cents over small integers, hence exact halves of the sixth decimal, which
    the two engines round to different sides; the sum with zero removes the sign of a zero.
    """
    out, i = [], 0
    while (start := sql.find("round(", i)) >= 0:
        depth, end = 1, start + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[start + 6:end - 1]
        value, comma, digits = inner.rpartition(",")
        whole = comma and digits.strip() == "6" and sql[start - 1:start] not in tuple("abcdefghijklmnopqrstuvwxyz_")
        out.append(sql[i:start])
        out.append(f"(round(({nudged(value)}) + {NUDGE}, 6) + 0.0)" if whole else f"round({nudged(inner)})")
        i = end
    return "".join(out) + sql[i:]


def round6(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(NUDGE), 6) + F.lit(0.0)  # no -0.0


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; without SQL it is checked by tests against brute force instead."""
    def add(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(fn, sql and nudged(sql))
        return fn
    return add
