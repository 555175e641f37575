"""Table schemas of the formatted zone and of the triples table."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


INDICATORS = _struct(
    ("municipality_id", _S), ("municipality_name", _S), ("comarca_name", _S),
    ("indicator_id", _S), ("indicator_name", _S), ("reference_year", _I),
    ("municipality_value", _D), ("comarca_value", _D), ("catalunya_value", _D),
    ("source_update_timestamp", T.TimestampType()),
)

# As landed: year and update time are 64-bit integers, the time in nanoseconds.
INDICATORS_LANDED = _struct(*[
    (f.name, _L if f.name in ("reference_year", "source_update_timestamp") else f.dataType)
    for f in INDICATORS.fields
])

RENT = _struct(
    ("ambit_territorial", _S), ("codi_territorial", _S), ("nom_territori", _S),
    ("any", _I), ("periode", _S), ("habitatges", _I), ("renda", _D), ("tram_preus", _S),
)

INCOME = _struct(
    ("year_code", _S), ("year_label", _S), ("municipality_id", _S), ("municipality_name", _S),
    ("concept_code", _S), ("concept_label", _S), ("indicator_code", _S),
    ("indicator_label", _S), ("value", _D),
)

TRIPLES = _struct(
    ("s", _S), ("p", _S), ("o", _S), ("o_kind", _S), ("o_lang", _S), ("o_type", _S), ("o_num", _D),
)
