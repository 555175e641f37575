"""Column functions: identifiers, coercions, literals and small formulas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraloom import vocab


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- identifiers ---------------------------------------------------------------------

def normalize_id(c: Column | str) -> Column:
    """Five-character code from one with or without leading zero and check digit."""
    text = _col(c).cast("string")
    return F.substring(F.when(F.length(text) == 5, F.lpad(text, 6, "0")).otherwise(text), 1, 5)


def drop_check_digit(c: Column | str) -> Column:
    """Code without its last character."""
    text = _col(c).cast("string")
    return F.substring(text, F.lit(1), F.length(text) - 1)


def slice_id(c: Column | str) -> Column:
    """First five characters of the trimmed code."""
    return F.substring(F.trim(_col(c).cast("string")), 1, 5)


# --- coercions: what cannot be read becomes null ---------------------------------------

def nanos_to_ts(c: Column | str) -> Column:
    """Timestamp from epoch nanoseconds, exact to the microsecond (floor)."""
    nanos = _col(c).cast("long")
    return F.timestamp_micros(
        ((nanos - F.pmod(nanos, F.lit(1000))).cast("decimal(20,0)") / 1000).cast("long")
    )


def to_number(c: Column | str) -> Column:
    return F.trim(_col(c).cast("string")).try_cast("double")


def to_int(c: Column | str) -> Column:
    return F.trim(_col(c).cast("string")).try_cast("int")


def to_utc(c: Column | str) -> Column:
    """Timestamp from ISO text; text without an offset is taken in the session zone (UTC)."""
    return F.try_to_timestamp(_col(c).cast("string"))


def split_levels(c: Column | str, names=("municipality_value", "comarca_value", "catalunya_value")):
    """Columns from a comma list; an underscore or an absent position is null."""
    parts = F.split(_col(c), ",", -1)
    return [F.nullif(F.get(parts, F.lit(i)), F.lit("_")).alias(n) for i, n in enumerate(names)]


# --- lookups -----------------------------------------------------------------------------

def lookup(c: Column | str, mapping: Mapping[str, object], default: Column | None = None) -> Column:
    """Value of a fixed dictionary for ``c``; null, or ``default``, when not listed.

    The dictionary becomes a map literal, so the expression stays inside code generation
    and needs no join.
    """
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, _col(c))
    return found if default is None else F.coalesce(found, default)


def imputed_from_brackets(value: Column | str, bracket: Column | str,
                          table: Mapping[str, float] | None = None) -> Column:
    """The value itself, else the midpoint of its bracket, else null."""
    return F.coalesce(_col(value), lookup(bracket, table or vocab.RENT_BRACKETS))


# --- graph terms -------------------------------------------------------------------------

_NAMED_KINDS = ("comarca", "province")  # identified by name, so spaces become underscores


def uri(kind: str, *parts: Column | str, base: str = vocab.NS) -> Column:
    """``<base><kind>/<part>_<part>``; null if a part is."""
    tail = [_col(p).cast("string") for p in parts]
    if kind in _NAMED_KINDS:
        tail = [F.replace(p, F.lit(" "), F.lit("_")) for p in tail]
    pieces = [F.lit(f"{base}{kind}/")]
    for i, part in enumerate(tail):
        pieces += ([F.lit("_")] if i else []) + [part]
    return F.concat(*pieces)


def _object(value, kind, lang=None, datatype=None, num=None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(
        value.cast("string").alias("o"),
        F.lit(kind).alias("o_kind"),
        (F.lit(lang) if lang else null).alias("o_lang"),
        (F.lit(datatype) if datatype else null).alias("o_type"),
        (num if num is not None else F.lit(None)).cast("double").alias("o_num"),
    )


def term_uri(c: Column | str) -> Column:
    return _object(_col(c), "uri")


def lit_plain(c: Column | str) -> Column:
    return _object(_col(c), "literal")


def lit_lang(c: Column | str, lang: str = "ca") -> Column:
    return _object(_col(c), "literal", lang=lang)


def lit_typed(c: Column | str, datatype: str) -> Column:
    """Typed literal; numeric types also carry their value as a double."""
    value = _col(c)
    return _object(value, "literal", datatype=datatype,
                   num=value if datatype in vocab.NUMERIC_TYPES else None)


# --- formulas ----------------------------------------------------------------------------

def affordability(rent: Column | str, income: Column | str) -> Column:
    """Yearly rent as a percentage of income; null without rent or positive income."""
    r, i = _col(rent), _col(income)
    return F.when(i > 0, F.try_divide(r * 12, i) * 100)


def fenced_block(c: Column | str) -> Column:
    """Text inside the outermost fence of a model reply, or the whole reply, trimmed."""
    text = _col(c)
    pattern = F.lit(r"(?is)```(?:sparql\s*)?(.*)```")
    body = F.when(F.regexp_like(text, pattern), F.regexp_extract(text, r"(?is)```(?:sparql\s*)?(.*)```", 1))
    return F.regexp_replace(F.coalesce(body, text), r"^\s+|\s+$", "")
