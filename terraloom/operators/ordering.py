"""Per-entity ordering: latest rows, keyed deduplication, lags, rolling means, sorts and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.session import cut_lineage


def _extreme_row(df: DataFrame, keys: Sequence[str], lead: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in lead]
    row = F.struct(*[F.col(f"`{c}`") for c in [*lead, *rest]])
    best = df.groupBy(*keys).agg(pick(row).alias("_row"))
    return best.select(*[
        F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; ties go to the greatest remaining columns.

    A maximum combines before the shuffle, so a key with a third of all rows is reduced to
    one row per task; ranking the rows in a window would sort them all.
    """
    return _extreme_row(df, keys, order, F.max)


def dedupe_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order`` and then by the remaining columns."""
    return _extreme_row(df, keys, order, F.min)


def latest_pivot(df: DataFrame, keys: Sequence[str], code: str, value: str, order: Sequence[str],
                 names: dict[str, str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Latest value of each code as columns, from a single shuffle on ``keys``.

    Equals ranking per (key, code), keeping the first and pivoting, without the second
    shuffle that those need. Keys with none of the codes still appear.
    """
    latest = [
        F.max(F.when(F.col(code) == c, F.struct(*order, value)))[value].alias(n)
        for c, n in names.items()]
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in (extra or {}).items()], *latest)


# --- lags ------------------------------------------------------------------------------------

_HELPERS = ("_hash", "_bucket", "_at", "_ghost")


def _chunked(df: DataFrame, keys: Sequence[str], order: str, reach: int, hot_rows: int | None):
    """Rows plus copies of the ``reach`` rows before each chunk, and the window of a chunk.

    A key with at most ``hot_rows`` rows is one chunk. A larger key is cut into chunks by
    ``order`` (a calendar year: few values) and by ranges of the tie-breaking row hash, and
    every chunk receives the last rows of the chunks before it, so that windows of a bounded
    size give the same lags as one window over the whole key. Whether there is such a key is
    asked when the plan is built, of the rows as written once to the shared folder, so that the
    input is computed once; usually there is none and one window suffices.
    """
    everything = [F.col(f"`{c}`") for c in df.columns]
    base = df.withColumn("_hash", F.xxhash64(*everything))
    base = base if hot_rows is None else cut_lineage(base)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    sizes = None if hot_rows is None else (
        df.filter(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows))
    if sizes is None or sizes.isEmpty():
        # Rows without a key take no part in any lag: their hash only spreads them out.
        spread = base.withColumns({"_bucket": F.when(~complete, F.pmod("_hash", F.lit(4096))).otherwise(F.lit(0)),
                                   "_at": F.lit(0), "_ghost": F.lit(False)})
        return spread, Window.partitionBy(*keys, "_bucket").orderBy(F.col(order).asc_nulls_last(), "_hash")

    ranges = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("_n") / F.lit(hot_rows))))
    hot = F.col("_n").isNotNull()
    tagged = base.join(sizes, list(keys), "left").select(
        *everything, "_hash",
        F.when(~complete, F.pmod("_hash", F.lit(4096)))
        .when(hot, F.floor(F.col("_hash") / (F.lit(2.0**64) / ranges)))
        .otherwise(F.lit(0)).cast("long").alias("_bucket"),
        F.when(hot, F.col(order)).alias("_at"),
        hot.alias("_hot"))
    chunk = [*keys, "_at", "_bucket"]
    newest = Window.partitionBy(*chunk).orderBy(F.col(order).desc_nulls_first(), F.col("_hash").desc())
    tails = (tagged.filter("_hot").withColumn("_rn", F.row_number().over(newest))
             .filter(F.col("_rn") <= reach)
             .groupBy(*chunk)
             .agg(F.sort_array(F.collect_list(F.struct(F.col("_rn"), F.struct(*everything, "_hash").alias("_row"))),
                               asc=False).alias("_tail")))
    before = (Window.partitionBy(*keys).orderBy(F.col("_at").asc_nulls_last(), "_bucket")
              .rowsBetween(-reach, -1))
    carried = tails.withColumn("_carry", F.flatten(F.collect_list("_tail").over(before))).select(
        F.col("_at"), F.col("_bucket"),
        F.explode(F.slice("_carry", F.greatest(F.size("_carry") - reach + 1, F.lit(1)), reach)).alias("_c"))
    ghosts = carried.select("_c._row.*", "_bucket", "_at", F.lit(True).alias("_ghost"))
    rows = tagged.drop("_hot").withColumn("_ghost", F.lit(False)).select(*ghosts.columns)
    window = Window.partitionBy(*chunk).orderBy(F.col(order).asc_nulls_last(), "_hash")
    # A chunk holds one order value: carried rows of the same value have smaller hashes, and
    # those of a null order come last, so the plain ordering places every copy first.
    return rows.unionByName(ghosts), window


def _over_chunks(df, keys, order, reach, hot_rows, columns) -> DataFrame:
    rows, window = _chunked(df, keys, order, reach, hot_rows)
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    made = {n: F.when(keyed, build(window)) for n, build in columns.items()}
    return rows.withColumns(made).filter(~F.col("_ghost")).select(*df.columns, *made)


def add_lags(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str],
             lags: Sequence[int] = (1, 2), hot_rows: int | None = 1_000_000) -> DataFrame:
    """``<col>_lag<k>``: the value k rows earlier of the same entity; gaps in years are ignored.

    Rows without a full key get null. Rows of equal key and year are ordered by their hash.
    """
    return _over_chunks(df, keys, order, max(lags), hot_rows, {
        f"{c}_lag{k}": (lambda w, c=c, k=k: F.lag(c, k).over(w)) for c in cols for k in lags})


def add_lag_diff(df: DataFrame, col: str) -> DataFrame:
    """``<col>_diff1``: first lag minus second lag."""
    return df.withColumn(f"{col}_diff1", F.col(f"{col}_lag1") - F.col(f"{col}_lag2"))


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, col: str, n: int = 3,
                 out: str | None = None, hot_rows: int | None = 1_000_000) -> DataFrame:
    """Mean of the last ``n`` rows up to the current one, over the values that are present."""
    return _over_chunks(df, keys, order, n - 1, hot_rows, {
        out or f"{col}_roll_mean{n}": lambda w: F.avg(col).over(w.rowsBetween(-(n - 1), 0))})


def time_columns(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], target: str,
                 rolled: str, hot_rows: int | None = 1_000_000) -> DataFrame:
    """Two lags of each column and the 3-row mean of the target's first lag, in one window."""
    made = {f"{c}_lag{k}": (lambda w, c=c, k=k: F.lag(c, k).over(w)) for c in cols for k in (1, 2)}
    made[rolled] = lambda w: F.avg(target).over(w.rowsBetween(-3, -1))
    return _over_chunks(df, keys, order, 3, hot_rows, made)


# --- splits ------------------------------------------------------------------------------------

def time_split(df: DataFrame, year: str, parts: int = 3) -> DataFrame:
    """Column ``split``: the last year is ``test``, the one before ``validation``, the rest ``train``.

    With two parts all earlier years are ``train``. The last years (at most ``parts`` values)
    are fetched when the plan is built, because too few of them is an error; the rows are written
    once for that and computed once.
    """
    df = cut_lineage(df.filter(F.col(year).isNotNull()))
    last = [r[0] for r in df.select(year).distinct()
            .orderBy(F.col(year).desc()).limit(parts).collect()]
    if len(last) < parts:
        raise ValueError(f"a split into {parts} parts needs as many years, found {sorted(last)}")
    split = F.when(F.col(year) == last[0], "test")
    if parts == 3:
        split = split.when(F.col(year) == last[1], "validation")
    return df.withColumn("split", split.otherwise("train"))


def split_report(df: DataFrame, year: str) -> DataFrame:
    """Rows and year range per split, and whether a year occurs in several splits."""
    per_year = df.groupBy("split", year).agg(F.count(F.lit(1)).alias("n"))
    shared = per_year.groupBy(year).agg(F.count(F.lit(1)).alias("splits"))
    return per_year.join(shared, year).groupBy("split").agg(
        F.sum("n").alias("rows"), F.min(year).alias("min_year"), F.max(year).alias("max_year"),
        (F.max("splits") > 1).alias("overlaps"))


# --- sort, limit, set operations -----------------------------------------------------------------

def sort_by(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*cols)


def top_k(df: DataFrame, col: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest value, merged from per-task heaps rather than a full sort."""
    return df.orderBy(F.col(col).desc_nulls_last(), *ties).limit(k)


def distinct_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return distinct_of(df, cols).orderBy(*cols)


def concat_frames(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
