"""Consolidated annual tables of rent, income and indicators per municipality."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom import vocab
from terraloom.functions.columns import affordability, imputed_from_brackets
from terraloom.operators.aggregate import representative, weighted_mean
from terraloom.operators.joins import join_dimension, outer_coalesced, outer_on
from terraloom.operators.ordering import latest_pivot
from terraloom.operators.quality import valid_years
from terraloom.operators.schema import add_null_columns, require_columns, select_existing
from terraloom.session import cut_lineage


def impute_from_brackets(df: DataFrame, value: str = "renda", bracket: str = "tram_preus",
                         table: Mapping[str, float] | None = None, out: str = "renda_imputed") -> DataFrame:
    return df.withColumn(out, imputed_from_brackets(value, bracket, table))


def _municipal_rent(rent: DataFrame) -> DataFrame:
    return impute_from_brackets(rent.filter(F.col("ambit_territorial") == "Municipi")).withColumnRenamed(
        "codi_territorial", "municipality_id")


def annual_rent(rent: DataFrame, with_name: bool = True) -> DataFrame:
    """Contracts and contract-weighted mean rent per municipality and year."""
    names = {"municipality_name": "nom_territori"} if with_name else None
    return weighted_mean(_municipal_rent(rent), ["municipality_id", "any"], "renda_imputed", "habitatges",
                         mean="avg_monthly_rent", total="total_contracts", names=names)


def latest_indicators(indicators: DataFrame, names: Mapping[str, str] = vocab.INDICATOR_NAMES,
                      order: tuple[str, ...] = ("reference_year",)) -> DataFrame:
    """Latest value of every indicator as columns, one row per municipality.

    Grouping is by id alone, with the smallest comarca name, so that varying names cannot
    multiply rows downstream.
    """
    return latest_pivot(indicators, ["municipality_id"], "indicator_id", "municipality_value", order,
                        dict(names), {"comarca_name": representative("comarca_name")})


def municipal_annual(rent: DataFrame, income: DataFrame, indicators: DataFrame,
                     names: Mapping[str, str] = vocab.INDICATOR_NAMES,
                     order: tuple[str, ...] = ("reference_year",)) -> DataFrame:
    """Annual table: rent full outer income per year, plus the latest indicators.

    Names come from the rent side only, so rows with income alone have none.
    """
    per_capita = income.filter(F.col("indicator_code") == "PER_CAPITA_EUR").select(
        "municipality_id", F.col("year").try_cast("int").alias("any"), F.col("value").alias("income_per_capita"))
    merged = outer_on(annual_rent(rent), per_capita, ["municipality_id", "any"], many="right")
    return join_dimension(merged, latest_indicators(indicators, names, order), "municipality_id")


def municipal_annual_v1(rent: DataFrame, income: DataFrame, indicators: DataFrame | None,
                        names: Mapping[str, str] = vocab.INDICATOR_COLUMNS,
                        order: tuple[str, ...] = ("reference_year",)) -> DataFrame:
    """Older annual table: names from either side, null rents counted as zero, fixed columns.

    Without indicators their columns are null.
    """
    rents = weighted_mean(
        _municipal_rent(rent), ["municipality_id", "any"], "renda_imputed", "habitatges",
        mean="avg_monthly_rent_eur", total="total_annual_contracts", null_as_zero=True,
        names={"municipality_name": "nom_territori"})
    salary = income.filter(F.col("indicator_code") == "PER_CAPITA_EUR").select(
        "municipality_id", "municipality_name", F.col("year").try_cast("int").alias("any"),
        F.col("value").alias("salary_per_capita_eur"))
    merged = outer_coalesced(rents, salary, ["municipality_id", "any"], ["municipality_name"], many="right")
    columns = [*vocab.ANNUAL_V1_COLUMNS[:7], *names.values()]
    if indicators is None:
        text = T.StructType([T.StructField("comarca_name", T.StringType())])
        for n in names.values():
            text = text.add(n, T.DoubleType())
        return select_existing(add_null_columns(merged, text), columns)
    require_columns(indicators, ["reference_year", "municipality_id", "municipality_name", "comarca_name",
                                 "indicator_id", "municipality_value"])
    wanted = indicators.filter(F.col("indicator_id").isin(list(names)))
    return select_existing(
        join_dimension(merged, latest_indicators(wanted, names, order), "municipality_id"), columns)


def annual_data(rent: DataFrame, income: DataFrame, discover: bool = False) -> DataFrame:
    """Annual rent full outer all income indicators; rows without id or year are left out.

    Both sides have one row per key. ``discover`` keeps income codes other than the three known
    ones as columns of their own, at the price of one more pass to find them.
    """
    keyed = income.withColumn("any", F.col("year").try_cast("int"))
    codes = list(vocab.INCOME_COLUMNS)
    if discover:
        extra = keyed.select("indicator_code").distinct().filter(
            F.col("indicator_code").isNotNull() & ~F.col("indicator_code").isin(codes))
        codes += sorted(r[0] for r in extra.collect())
    wide = (keyed.groupBy("municipality_id", "any").pivot("indicator_code", codes).agg(F.max("value"))
            .withColumnsRenamed(vocab.INCOME_COLUMNS))
    return outer_on(annual_rent(rent, with_name=False), wide, ["municipality_id", "any"]).filter(
        F.col("municipality_id").isNotNull() & F.col("any").isNotNull())


def affordability_map(polys: DataFrame, annual: DataFrame, poly_key: str = "id", low: float = 10.0,
                      high: float = 50.0, rent: str = "avg_monthly_rent_eur",
                      income: str = "salary_per_capita_eur") -> DataFrame:
    """Map table of every year with data: all polygons, their share and its value on the colour scale.

    A polygon appears once per such year; one without figures for it is marked missing. The
    years come from a small distinct, and the polygons are repeated per year before the join so
    that it stays an equi-join. The annual rows are written once for both uses.
    """
    require_columns(annual, ["municipality_id", "any", rent, income, "municipality_name"])
    annual = cut_lineage(annual.select("municipality_id", "any", rent, income, "municipality_name"))
    years = valid_years(annual, "any", [rent, income]).collect()  # calendar years
    listed = F.array(*[F.lit(r[0]) for r in years]) if years else F.array().cast("array<int>")
    base = polys.select(F.col(poly_key).cast("string").alias("polygon_id"), F.explode(listed).alias("year"))
    share = annual.select(
        F.col("municipality_id").cast("string").alias("polygon_id"), F.col("any").alias("year"),
        "municipality_name", affordability(rent, income).alias("affordability_pct"))
    joined = base.join(share, ["polygon_id", "year"], "left")
    pct = F.col("affordability_pct")
    return joined.select(
        "polygon_id", "year", "municipality_name", "affordability_pct",
        F.when(pct.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), pct))).alias("scale_value"),
        pct.isNull().alias("missing"))
