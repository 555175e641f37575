import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terraloom import vocab
from terraloom.operators import aggregate as A
from terraloom.operators import quality as Q
from terraloom.plans import cleaning

NAN = float("nan")


def test_range_semantics(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (-1.0,), (NAN,), (None,)], "v double")
    assert df.filter(Q.in_range("v", 0, 10)).count() == 2
    assert df.filter(Q.null_or_range("v", 0, 10)).count() == 3
    assert df.filter(Q.greater_than("v", 0)).count() == 3  # NaN is above every number
    assert Q.null_nan_count(df, "v").first()[0] == 2
    assert Q.dropna(df, ["v"]).count() == 4


def test_text_rules(spark):
    df = spark.createDataFrame([("1999",), ("2020",), ("abc",), (None,)], "y string")
    assert df.filter(Q.text_int_in_range("y", 2000, 2025)).count() == 1
    assert df.filter(Q.length_is("y", 4)).count() == 2


def test_keyed_ranges(spark):
    df = spark.createDataFrame([("f328", 2.0), ("f328", 9.0), ("f328", None), ("f999", None), (None, 1.0), ("f171", -1.0)], "k string, v double")
    kept = Q.keyed_ranges(df, "k", "v", vocab.INDICATOR_RANGES).collect()
    assert {(r.k, r.v) for r in kept} == {("f328", 2.0), ("f999", None), (None, 1.0)}


def test_rule_report_partitions_the_input(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (None, None), (3, None), (50, "b"), (2, "c")], "n int, t string")
    clean, report = Q.apply_rules(df, [Q.Rule("t", F.col("t").isNotNull()), Q.Rule("n", Q.in_range("n", 0, 10))])
    assert [tuple(r) for r in report.orderBy("step").collect()] == [(1, "t", 6, 4, 2), (2, "n", 4, 2, 2)]
    assert clean.count() == 2


def test_clean_indicators_applies_value_rules(spark):
    schema = "municipality_id string, indicator_id string, reference_year int, municipality_value double, municipality_name string"
    df = spark.createDataFrame([
        ("08019", "f171", 2020, 5.0, "b"), ("08019", "f171", 2020, 5.0, "a"), ("08019", "f171", 2021, None, "a"),
        ("08019", "fX", 2021, None, "a"), ("08019", "f171", 1999, 5.0, "a"), ("08019", "f171", 2026, 5.0, "a"), (None, "f171", 2020, 1.0, "a")], schema)
    clean, report = cleaning.clean_indicators(df)
    assert {(r.indicator_id, r.reference_year, r.municipality_name) for r in clean.collect()} == {("f171", 2020, "a"), ("fX", 2021, "a")}
    assert [r.rows_removed for r in report.orderBy("step").collect()] == [1, 2, 1]
    literal, _ = cleaning.clean_indicators(df, apply_value_rules=False)
    assert literal.count() == 3


def test_clean_rent_and_income(spark):
    rent = spark.createDataFrame([
        ("Municipi", "08019", "B", 2020, "T1", 5, 700.0, "x"), ("Municipi", "08019", "B", 2020, "T1", 4, 800.0, "x"),
        ("Municipi", "08019", "B", 2004, "T1", 5, 700.0, "x"), ("Municipi", "08019", "B", 2020, "T2", 5, None, "x"),
        ("Municipi", "08019", None, 2020, "T3", 5, 1.0, "x"), ("Municipi", "08019", "B", 2020, "T4", -1, 1.0, "x"),
        ("Municipi", "08019", "B", 9999, "T1", 5, 1.0, "x")],
        "ambit_territorial string, codi_territorial string, nom_territori string, any int, periode string, habitatges int, renda double, tram_preus string")
    clean, report = cleaning.clean_rent(rent)
    assert sorted((r.periode, r.habitatges) for r in clean.collect()) == [("T1", 4), ("T2", 5)]
    assert [r.rows_removed for r in report.orderBy("step").collect()] == [1, 2, 1, 0]
    income = spark.createDataFrame([
        ("c1", "2020", "080193", 5.0), ("c2", "2020", "080193", 5.0), ("c1", "abc", "080193", 5.0), ("c1", "2020", "8019", 5.0),
        ("c1", "2020", "080193", NAN), ("c1", "2020", "080193", -1.0), ("c1", "2020", "080193", None)],
        "concept_code string, year_label string, municipality_id string, value double")
    clean, report = cleaning.clean_income(income)
    assert [tuple(r) for r in clean.select("year", "municipality_id", "value").collect()] == [("2020", "08019", 5.0)]
    assert [r.rows_removed for r in report.orderBy("step").collect()] == [1, 1, 3]


def test_weighted_mean_of_nulls(spark):
    df = spark.createDataFrame([("a", 10.0, 1), ("a", None, 3), ("b", None, 2), ("c", 5.0, 0), ("d", None, None)], "k string, v double, w int")
    plain = {r.k: (r.total, r.mean) for r in A.weighted_mean(df, ["k"], "v", "w", mean="mean", total="total").collect()}
    zero = {r.k: (r.total, r.mean) for r in A.weighted_mean(df, ["k"], "v", "w", mean="mean", total="total", null_as_zero=True).collect()}
    assert plain == {"a": (4, 2.5), "b": (2, None), "c": (0, None), "d": (None, None)}
    assert zero == {"a": (4, 2.5), "b": (2, 0.0), "c": (0, None), "d": (None, None)}


def test_conflicts(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 1.0), ("b", 1, 1.0), ("b", 2, 1.0), ("c", 1, None), ("c", 1, 2.0), ("d", 9, 9.0)], "k string, x int, y double")
    got = [tuple(r) for r in A.conflicting_keys(df, ["k"], ["x", "y"]).collect()]
    assert got == [("b", 2, 2, 1)]
    assert A.conflicting_keys(df, ["k"], ["x"]).count() == 1


def test_quantiles_match_pandas(spark):
    rng = random.Random(1)
    values = [rng.choice([rng.random() * 100, 7.0, -3.0]) for _ in range(777)]
    other = [float(i % 13) if i % 5 else None for i in range(777)]
    df = spark.createDataFrame(list(zip(values, other)), "a double, b double").repartition(5)
    got = {r["column"]: r for r in A.describe_numeric(df).collect()}
    for name, data in (("a", values), ("b", other)):
        want = pd.Series(data, dtype=float).describe()
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[name][ours] == pytest.approx(want[theirs])


def test_regression_metrics(spark):
    rng = np.random.default_rng(0)
    y, p = rng.normal(5, 2, 200), rng.normal(5, 2, 200)
    got = A.regression_metrics(spark.createDataFrame(pd.DataFrame({"y": y, "p": p})), "y", "p").first()
    mse = ((y - p) ** 2).mean()
    assert got.r2 == pytest.approx(1 - mse / y.var())
    assert got.mae == pytest.approx(np.abs(y - p).mean())
    assert (got.mse, got.rmse) == (pytest.approx(mse), pytest.approx(math.sqrt(mse)))
    assert got.mape == pytest.approx(np.mean(np.abs(y - p) / np.abs(y)))


def test_collect_in_parts_keeps_hot_keys_whole(spark):
    rows = [("hot", i % 900) for i in range(2000)] + [("cold", 1), ("cold", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    out = A.collect_in_parts(df, ["k"], F.col("v"), "vs", part_size=100).collect()
    hot = [r for r in out if r.k == "hot"]
    assert len(hot) > 5 and max(len(r.vs) for r in hot) < 200
    assert sorted(v for r in hot for v in r.vs) == list(range(900))
    assert [(r.part, r.vs) for r in out if r.k == "cold"] == [(0, [1, 2])]


def test_graph_counts_and_missing(spark, rows):
    t = spark.createDataFrame([("a", vocab.RDF_TYPE, "C"), ("b", vocab.RDF_TYPE, "C"), ("a", "p", "b")], "s string, p string, o string")
    assert rows(A.graph_counts(t)) == [("class", "C", 2), ("graph", "", 3), ("predicate", vocab.RDF_TYPE, 2), ("predicate", "p", 1)]
    assert rows(A.missing_counts(spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string"))) == [("a", 1), ("b", 2)]
