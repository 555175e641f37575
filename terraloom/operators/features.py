"""Feature tables: time features, selection, scaling and category codes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.operators.aggregate import numeric_columns
from terraloom.operators.embeddings import dense_ids
from terraloom.operators.ordering import add_lag_diff, time_columns


def time_features(df: DataFrame, keys: Sequence[str] = ("municipality_id",), year: str = "any",
                  target: str = "avg_monthly_rent",
                  measures: Sequence[str] = ("total_contracts", "income_per_capita"),
                  difference: bool = False, hot_rows: int | None = 1_000_000) -> DataFrame:
    """Lags 1 and 2 of the target and measures, and the 3-row mean of the target's first lag.

    ``difference`` adds lag 1 minus lag 2 (the older feature set, whose mean is named without
    the lag). Absent measures are skipped; rows with a null key get null features.
    """
    cols = [c for c in (target, *measures) if c in df.columns]
    rolled = f"{target}_roll_mean3" if difference else f"{target}_roll_mean3_lag1"
    out = time_columns(df, keys, year, cols, target, rolled, hot_rows)
    return add_lag_diff(out, target) if difference else out


def feature_columns(df: DataFrame, target: str = "avg_monthly_rent",
                    categorical: Sequence[str] = ("comarca_name",)) -> list[str]:
    """All numeric columns but the target, and the categorical ones, sorted."""
    numeric = [c for c in numeric_columns(df) if c != target]
    return sorted({*numeric, *[c for c in categorical if c in df.columns]})


def fixed_feature_columns(df: DataFrame, base: Sequence[str], year: str, engineered: Sequence[str],
                          categorical: Sequence[str] = ("comarca_name",)) -> list[str]:
    """The listed columns that exist, in the listed order (older feature set)."""
    return [c for c in (*base, year, *engineered, *categorical) if c in df.columns]


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column."""

    stats: dict[str, tuple[float | None, float | None]]

    def to_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, m, s) for c, (m, s) in self.stats.items()],
                                     "column string, mean double, std double")


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> Scaler:
    """Statistics of the training rows; nulls and NaN are ignored. Fetches one row."""
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    row = train.agg(*[e for i, x in enumerate(clean.values())
                      for e in (F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"))]).first()
    return Scaler({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)})


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Centred and scaled columns; a column without spread is only centred."""
    def scaled(c: str, mean: float | None, std: float | None):
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(c).cast("double") - mean) / (std or 1.0)
    return df.withColumns({c: scaled(c, *v) for c, v in scaler.stats.items()})


def fit_categories(train: DataFrame, col: str) -> DataFrame:
    """Sorted training categories with codes from 0: ``<col>, code``."""
    return dense_ids(train, col, "code")


def encode_categories(df: DataFrame, categories: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Column with the code of each category; one not seen in training is null."""
    codes = categories.select(F.col(col), F.col("code").alias(out or f"{col}_code"))
    return df.join(codes, col, "left")
