import datetime
import warnings

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terraloom import schemas, vocab
from terraloom.functions import columns as C
from terraloom.operators import schema as S


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr.alias("x")).first()[0]


@pytest.mark.parametrize("given,wanted", [("80193", "08019"), ("080193", "08019"), ("250019", "25001"), ("123", "123"), (None, None)])
def test_normalize_id(spark, given, wanted):
    assert one(spark, C.normalize_id("c"), given) == wanted


def test_id_slices(spark):
    assert one(spark, C.drop_check_digit("c"), "080193") == "08019"
    assert one(spark, C.drop_check_digit("c"), "") == ""
    assert one(spark, C.slice_id("c"), " 080193 ") == "08019"


@pytest.mark.parametrize("nanos,micros", [(1_700_000_000_123_456_789, 1_700_000_000_123_456), (-1, -1), (0, 0), (1_999_999_999_999_999_999, 1_999_999_999_999_999)])
def test_nanoseconds_are_exact(spark, nanos, micros):
    assert one(spark, F.unix_micros(C.nanos_to_ts("c")), nanos, "long") == micros


def test_coercions(spark):
    assert one(spark, C.to_number("c"), " 1.5 ") == 1.5
    assert one(spark, C.to_number("c"), "x") is None
    assert one(spark, C.to_int("c"), "2021") == 2021
    assert one(spark, C.to_int("c"), "") is None
    assert one(spark, C.to_utc("c"), "nope") is None
    assert one(spark, F.unix_micros(C.to_utc("c")), "2024-01-05T00:00:00") == 1_704_412_800_000_000
    assert one(spark, F.unix_micros(C.to_utc("c")), "2024-01-05T02:00:00+02:00") == 1_704_412_800_000_000


def test_split_levels(spark):
    df = spark.createDataFrame([("10,_,30",), ("7",), ("_,2",)], "v string")
    got = [tuple(r) for r in df.select(*C.split_levels("v")).collect()]
    assert got == [("10", None, "30"), ("7", None, None), (None, "2", None)]


def test_brackets(spark):
    table = {**{k: v for k, v in vocab.RENT_BRACKETS.items()}, "unknown": None}
    for bracket, rent in table.items():
        assert one(spark, C.imputed_from_brackets(F.lit(None).cast("double"), "c"), bracket) == rent
    assert one(spark, C.imputed_from_brackets(F.lit(10.0), "c"), "> 650 euros/mes") == 10.0


def test_terms(spark):
    assert one(spark, C.uri("comarca", "c"), "Alt Camp") == vocab.NS + "comarca/Alt_Camp"
    assert one(spark, C.uri("datapoint", "c", F.lit(2020)), "08019") == vocab.NS + "datapoint/08019_2020"
    assert one(spark, C.uri("comarca", "c"), None) is None
    assert tuple(one(spark, C.lit_typed("c", vocab.XSD_GYEAR), 2021, "int")) == ("2021", "literal", None, vocab.XSD_GYEAR, 2021.0)
    assert tuple(one(spark, C.lit_lang("c"), "Olot")) == ("Olot", "literal", "ca", None, None)


def test_affordability(spark):
    df = spark.createDataFrame([(500.0, 20000.0), (None, 1.0), (5.0, 0.0), (5.0, None), (5.0, -1.0)], "r double, i double")
    assert [r[0] for r in df.select(C.affordability("r", "i")).collect()] == [30.0, None, None, None, None]


@pytest.mark.parametrize("reply,query", [
    ("Sure\n```sparql\nSELECT 1\n```\nbye", "SELECT 1"), ("```\nSELECT 2```", "SELECT 2"), ("  SELECT 3 \n", "SELECT 3"),
    ("```SPARQL SELECT 4```", "SELECT 4"), ("``````", ""), (None, None), ("```a``` and ```b```", "a``` and ```b")])
def test_fenced_block(spark, reply, query):
    assert one(spark, C.fenced_block("c"), reply) == query


def test_conform(spark):
    df = spark.createDataFrame([("a", 2021, 5_000, "x")], "municipality_id string, reference_year long, source_update_timestamp long, municipality_value string")
    out = S.conform(df, schemas.INDICATORS)
    assert out.schema == schemas.INDICATORS
    row = out.first()
    assert (row.reference_year, row.municipality_value, row.comarca_name) == (2021, None, None)
    assert row.source_update_timestamp == datetime.datetime.fromtimestamp(5e-6)


def test_reshape(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert S.rename_select(df, {"b": "y", "z": "w", "a": "x"}).columns == ["y", "x"]
    assert any("z" in str(w.message) for w in seen)
    assert S.drop_if_present(df, ["a", "q"]).columns == ["b"]
    assert S.rename_if_present(df, {"a": "x", "q": "r"}).columns == ["x", "b"]
    assert S.select_existing(df, ["b", "q"]).columns == ["b"]
    with pytest.raises(ValueError):
        S.select_existing(df, ["q"])
    with pytest.raises(ValueError, match="q"):
        S.require_columns(df, ["a", "q"])
    assert S.ensure_columns(df, ["a", "n"]).dtypes == [("a", "int"), ("b", "int"), ("n", "double")]
    assert S.add_null_columns(df, T.StructType().add("t", "string")).dtypes[-1] == ("t", "string")
    empty = S.empty_like(spark, schemas.RENT)
    assert empty.schema == schemas.RENT and empty.count() == 0
    mapped = S.map_column(spark.createDataFrame([("Osona",), ("?",)], "c string"), "c", vocab.COMARCA_PROVINCE)
    assert [r[0] for r in mapped.collect()] == ["Barcelona", None]


def test_fixed_tables():
    assert len(vocab.INDICATOR_NAMES) == len(vocab.INDICATOR_RANGES) == 15
    assert len(vocab.COMARCA_PROVINCE) == 43 and set(vocab.COMARCA_PROVINCE.values()) == {"Barcelona", "Girona", "Lleida", "Tarragona"}
    assert len(vocab.ANNUAL_V1_COLUMNS) == 22
