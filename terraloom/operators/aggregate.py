"""Aggregations. All of them combine on the map side, so one hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terraloom import vocab
from terraloom.functions.columns import lookup
from terraloom.session import cut_lineage


def representative(c: str) -> Column:
    """One value of a column for a whole group, independent of row order: the smallest."""
    return F.min(c)


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str, *,
                  mean: str, total: str, null_as_zero: bool = False,
                  names: Mapping[str, str] | None = None) -> DataFrame:
    """Weight total and weighted mean per key, with representatives of the ``names`` columns.

    A null value counts in the weights only. When all of a group's values are null the mean
    is null, or 0 with ``null_as_zero``, which also requires a positive weight total. Sums are
    taken per key and name first: an aggregate with text in its state would sort all input rows,
    while this one hashes them and sorts a row per key and name.
    """
    names = dict(names or {})
    product = F.col(value) * F.col(weight)
    if null_as_zero:
        product = F.when(F.col(value).isNotNull(), product).otherwise(F.lit(0.0))
    sums = df.groupBy(*keys, *[F.col(c).alias(f"_{n}") for n, c in names.items()]).agg(
        F.sum(weight).alias(total), F.sum(product).alias("_product"))
    if names:
        sums = sums.groupBy(*keys).agg(
            *[representative(f"_{n}").alias(n) for n in names],
            F.sum(total).alias(total), F.sum("_product").alias("_product"))
    ratio = F.try_divide(F.col("_product"), F.col(total))
    if null_as_zero:
        ratio = F.when(F.col(total) > 0, ratio)
    return sums.withColumn(mean, ratio).drop("_product")


def pivot_values(df: DataFrame, keys: Sequence[str], col: str, value: str,
                 values: Sequence[str] | None = None) -> DataFrame:
    """Long to wide; one of several values in a cell is the largest.

    Without ``values`` the codes are discovered by one extra distinct job.
    """
    grouped = df.groupBy(*keys)
    return (grouped.pivot(col, list(values)) if values else grouped.pivot(col)).agg(F.max(value))


def conflicting_keys(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys with several rows that disagree on some value, with the counts.

    Counts, minima and maxima, which combine before the shuffle, find the keys; distinct values
    are counted only for their rows.
    """
    found = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_rows_per_key"),
        *[F.min(v).alias(f"_least_{v}") for v in values], *[F.max(v).alias(f"_most_{v}") for v in values])
    differs = reduce(lambda a, b: a | b, [F.col(f"_least_{v}") != F.col(f"_most_{v}") for v in values])
    found = found.filter((F.col("num_rows_per_key") > 1) & differs).select(*keys, "num_rows_per_key")
    same = reduce(lambda a, b: a & b, [F.col(f"d.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys])
    rows = df.alias("d").join(found.alias("f"), same)
    one = lambda i, v: F.struct(F.lit(i).alias("i"), F.col(f"d.{v}").cast("string").alias("v"))
    told = rows.select(*[F.col(f"d.{k}") for k in keys], "num_rows_per_key",
                       F.explode(F.array(*[one(i, v) for i, v in enumerate(values)])).alias("_told")).distinct()
    counts = [F.count(F.when(F.col("_told.i") == i, F.col("_told.v"))).alias(f"distinct_{v}") for i, v in enumerate(values)]
    return told.groupBy(*keys, "num_rows_per_key").agg(*counts)


def dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def value_range(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("actual_min"), F.max(col).alias("actual_max"))


def count_distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count and number of distinct combinations (a null is a value of its own)."""
    per_pair = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return per_pair.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                        F.count(F.lit(1)).alias("distinct_pairs"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles as ``column, prob, value``, exact at any size.

    Values are counted, range-sorted over all tasks and materialised once; positions then
    follow from one small table of per-partition totals. No task holds a whole column, which
    an in-memory percentile aggregate would.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ordered = cut_lineage(
        counted.repartitionByRange("column", "value").sortWithinPartitions("column", "value"))
    placed = ordered.withColumn("part", F.spark_partition_id())
    totals = placed.groupBy("column", "part").agg(F.sum("n").alias("size"))
    parts = Window.partitionBy("column").orderBy("part")
    offsets = totals.select(
        "column", "part",
        (F.sum("size").over(parts) - F.col("size")).alias("before"),
        F.sum("size").over(Window.partitionBy("column")).alias("rows"))
    inside = Window.partitionBy("column", "part").orderBy("value")
    ranked = (placed.withColumn("upto", F.sum("n").over(inside))
              .join(offsets, ["column", "part"])
              .select("column", "value", "rows",
                      (F.col("before") + F.col("upto") - F.col("n")).alias("first"),
                      (F.col("before") + F.col("upto") - 1).alias("last")))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    hits = ranked.select("column", "value", "first", "last", "rows", wanted.alias("prob"))
    at = (F.col("rows") - 1) * F.col("prob")
    lower, upper = F.floor(at), F.ceil(at)
    holds = lambda k: F.col("first").__le__(k) & F.col("last").__ge__(k)
    found = hits.filter(holds(lower) | holds(upper)).groupBy("column", "prob").agg(
        F.max(F.when(holds(lower), F.col("value"))).alias("lo"),
        F.max(F.when(holds(upper), F.col("value"))).alias("hi"),
        F.max(at - lower).alias("frac"))
    return found.select("column", "prob",
                        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("value"))


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column."""
    cols = list(cols or numeric_columns(df))
    number = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    moments = df.agg(*[
        F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                 F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(c)
        for c, x in number.items()
    ]).select(F.inline(F.array(*[F.col(f"`{c}`") for c in cols])))
    quartiles = exact_quantiles(df, cols, (0.25, 0.5, 0.75)).groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
        for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def missing_counts(df: DataFrame) -> DataFrame:
    """Number of nulls per column, for the columns that have any."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "missing").filter(F.col("missing") > 0)


def metrics_wide(metrics: DataFrame, names: Sequence[str] = tuple(vocab.METRIC_NAMES)) -> DataFrame:
    """Experiments by metrics, best first by the leading metric, under display names."""
    wide = metrics.groupBy("experiment").pivot("metric", list(names)).agg(F.max("value"))
    shown = [F.col(n).alias(vocab.METRIC_NAMES.get(n, n)) for n in names]
    return wide.orderBy(F.col(names[0]).desc_nulls_last(), "experiment").select("experiment", *shown)


def metric_display(c: Column | str) -> Column:
    return lookup(c, vocab.METRIC_NAMES, F.col(c) if isinstance(c, str) else c)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """R2, MAE, MSE, RMSE and MAPE in one pass."""
    y, p = F.col(label), F.col(prediction)
    err = y - p
    floor = F.lit(2.220446049250313e-16)  # smallest denominator of a percentage error
    sums = df.filter(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"),
        F.var_pop(y).alias("var"), F.avg(F.abs(err)).alias("mae"),
        F.avg(F.abs(err) / F.greatest(F.abs(y), floor)).alias("mape"))
    mse = F.try_divide(F.col("sse"), F.col("n"))
    return sums.select(
        (1 - F.try_divide(mse, F.col("var"))).alias("r2"), "mae", mse.alias("mse"),
        F.sqrt(mse).alias("rmse"), "mape")


def collect_in_parts(df: DataFrame, keys: Sequence[str], item: Column, name: str,
                     part_size: int = 100_000) -> DataFrame:
    """Sorted distinct items per key as ``keys, part, <name>``.

    A key with more than ``part_size`` items is spread over parts by the item's hash, so a
    list is never longer than a task can hold and no item is dropped; other keys have part 0.
    """
    items = df.select(*keys, item.alias("_item")).distinct()
    sizes = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > part_size)
    placed = items.join(sizes, list(keys), "left").select(
        *keys, "_item",
        F.coalesce(
            F.pmod(F.xxhash64("_item"), F.ceil(F.col("_n") / F.lit(part_size))), F.lit(0)
        ).cast("int").alias("part"))
    return placed.groupBy(*keys, "part").agg(F.sort_array(F.collect_list("_item")).alias(name))


def neighbor_lists(edges: DataFrame, key: Sequence[str] = ("id",),
                   item: Sequence[str] = ("neighbor_id", "neighbor_name"),
                   part_size: int = 100_000) -> DataFrame:
    """Neighbours of each entity as sorted lists of structs."""
    return collect_in_parts(edges, key, F.struct(*item), "neighbors", part_size)


def graph_counts(triples: DataFrame) -> DataFrame:
    """Triples per predicate, typed subjects per class, and the graph size, in one pass."""
    is_type = F.col("p") == vocab.RDF_TYPE
    sets = F.array(
        F.struct(F.lit("graph").alias("kind"), F.lit("").alias("name")),
        F.struct(F.lit("predicate").alias("kind"), F.col("p").alias("name")),
        F.when(is_type, F.struct(F.lit("class").alias("kind"), F.col("o").alias("name"))))
    return (triples.select("p", F.when(is_type, F.col("o")).alias("o"))
            .groupBy("p", "o").agg(F.count(F.lit(1)).alias("n"))
            .select("n", F.explode(F.filter(sets, lambda x: x.isNotNull())).alias("g"))
            .groupBy("g.kind", "g.name").agg(F.sum("n").alias("triples")))
