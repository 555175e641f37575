"""Formatting and cleaning of the three sources, with a report per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom import schemas, vocab
from terraloom.functions.columns import drop_check_digit, normalize_id
from terraloom.operators.aggregate import dedupe
from terraloom.operators.cube import flatten_cube
from terraloom.operators.ordering import dedupe_keys
from terraloom.operators.quality import (
    Rule, apply_rules, in_range, keyed_range, length_is, not_null, null_or_range, text_int_in_range,
)
from terraloom.operators.schema import conform, drop_if_present, rename_if_present, rename_select

RENT_KEY = ["ambit_territorial", "nom_territori", "codi_territorial", "any", "periode", "tram_preus"]
INDICATOR_KEY = ["municipality_id", "indicator_id", "reference_year"]


def format_indicators(landed: DataFrame) -> DataFrame:
    """Fixed schema, five-character ids, update time from nanoseconds."""
    return conform(landed.withColumn("municipality_id", normalize_id("municipality_id")), schemas.INDICATORS)


def format_rent(landed: DataFrame) -> DataFrame:
    return conform(landed, schemas.RENT)


def format_income(cubes: DataFrame) -> DataFrame:
    """Income rows from cubes over year, municipality, concept and indicator."""
    flat = flatten_cube(cubes, ("YEAR", "MUN", "CONCEPT", "INDICATOR"))
    return rename_select(flat, vocab.INCOME_RENAMES)


def clean_indicators(df: DataFrame, years: tuple[int, int] = (2000, 2025), apply_value_rules: bool = True,
                     ranges=vocab.INDICATOR_RANGES) -> tuple[DataFrame, DataFrame]:
    """Indicators with full keys, a plausible year and value, one row per key; and the report."""
    rules = [Rule("keys present", not_null(INDICATOR_KEY)),
             Rule("year in range", in_range("reference_year", *years))]
    if apply_value_rules:
        rules.append(Rule("value plausible", keyed_range("indicator_id", "municipality_value", ranges)))
    clean, report = apply_rules(df, rules)
    return dedupe_keys(clean, INDICATOR_KEY), report


def clean_rent(df: DataFrame, min_year: int = 2005, max_year: int | Column | None = None,
               max_count: int = 99_999, max_rent: float = 9_999_999.0) -> tuple[DataFrame, DataFrame]:
    """Rent rows with full keys and plausible figures, one per key; years up to the next by default."""
    if max_year is None:
        max_year = F.year(F.current_date()) + 1
    essential = ["ambit_territorial", "codi_territorial", "nom_territori", "any", "periode", "tram_preus"]
    clean, report = apply_rules(df, [
        Rule("keys present", not_null(essential)),
        Rule("year in range", in_range("any", min_year, max_year)),
        Rule("contracts in range", in_range("habitatges", 0, max_count)),
        Rule("rent missing or in range", null_or_range("renda", 0, max_rent))])
    return dedupe_keys(clean, RENT_KEY), report


def clean_income(df: DataFrame, years: tuple[int, int] = (2000, 2025),
                 max_value: float = 999_999_999.0) -> tuple[DataFrame, DataFrame]:
    """Income rows: unused columns dropped, exact duplicates removed, then the rules."""
    slim = rename_if_present(drop_if_present(df, ["concept_code", "concept_label", "year_code"]),
                             {"year_label": "year"})
    rows = dedupe(slim.withColumn("municipality_id", drop_check_digit("municipality_id")))
    return apply_rules(rows, [
        Rule("year in range", text_int_in_range("year", *years)),
        Rule("id of five characters", length_is("municipality_id", 5)),
        Rule("value in range", in_range("value", 0, max_value))])
