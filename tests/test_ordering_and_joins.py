import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from terraloom.operators import features as X
from terraloom.operators import joins as J
from terraloom.operators import ordering as O


def test_latest_and_dedupe(spark, rows):
    df = spark.createDataFrame([("a", "i", 2020, 1.0), ("a", "i", 2021, 2.0), ("a", "i", 2021, 3.0), ("a", "i", None, 9.0), ("b", "i", None, 4.0)],
                               "m string, i string, y int, v double")
    assert rows(O.latest_per_key(df, ["m", "i"], ["y"])) == [("a", "i", 2021, 3.0), ("b", "i", None, 4.0)]
    assert O.latest_per_key(df, ["m", "i"], ["y"]).columns == df.columns
    assert rows(O.dedupe_keys(df.filter("y is not null"), ["m"], ["y"])) == [("a", "i", 2020, 1.0)]


def test_latest_pivot_equals_rank_then_pivot(spark, rows):
    rng = random.Random(3)
    data = [(f"m{rng.randrange(9)}", rng.choice("xyz"), rng.randrange(2000, 2005), i, rng.random()) for i in range(400)]
    df = spark.createDataFrame(data, "m string, c string, y int, id int, v double")
    names = {"x": "X", "y": "Y"}
    got = rows(O.latest_pivot(df, ["m"], "c", "v", ["y", "id"], names))
    ranked = O.latest_per_key(df, ["m", "c"], ["y", "id"]).groupBy("m").pivot("c", ["x", "y"]).agg(F.first("v"))
    assert got == rows(ranked)


def _pandas_features(pdf):
    pdf = pdf.sort_values(["k", "y"]).reset_index(drop=True)
    g = pdf.groupby("k")["v"]
    pdf["v_lag1"], pdf["v_lag2"] = g.shift(1), g.shift(2)
    pdf["roll"] = pdf.groupby("k")["v_lag1"].rolling(3, min_periods=1).mean().reset_index(level="k", drop=True)
    return pdf


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 3])
def test_time_columns_match_pandas(spark, hot_rows):
    rng = random.Random(5)
    data = [(f"k{i}", y, None if rng.random() < 0.2 else rng.random()) for i in range(6) for y in range(2000, 2012) if rng.random() < 0.8]
    data += [("single", 2003, 1.5), (None, 2001, 1.0), (None, 2002, 2.0)]
    df = spark.createDataFrame(data, "k string, y int, v double").repartition(4)
    out = O.time_columns(df, ["k"], "y", ["v"], "v", "roll", hot_rows).toPandas()
    assert len(out) == len(data)
    nokey = out[out.k.isna()]
    assert len(nokey) == 2 and nokey[["v_lag1", "v_lag2", "roll"]].isna().all().all()
    want = _pandas_features(pd.DataFrame([d for d in data if d[0]], columns=["k", "y", "v"]))
    got = out[out.k.notna()].sort_values(["k", "y"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_hot_key_with_repeated_years(spark):
    """A key with many rows per year gives the same lags however it is cut."""
    data = [("hot", 2000 + i % 3, float(i)) for i in range(300)] + [("cold", 2000, 1.0), ("cold", None, 2.0)]
    df = spark.createDataFrame(data, "k string, y int, v double").repartition(4)
    plain = O.add_lags(df, ["k"], "y", ["v"], (1, 2), None)
    cut = O.add_lags(df, ["k"], "y", ["v"], (1, 2), 7)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))
    rolled = O.rolling_mean(df, ["k"], "y", "v", 3, "r", None)
    cut_rolled = O.rolling_mean(df, ["k"], "y", "v", 3, "r", 7)
    assert sorted(map(str, rolled.collect())) == sorted(map(str, cut_rolled.collect()))


def test_feature_set(spark):
    df = spark.createDataFrame([("a", 2000, 1.0, 5), ("a", 2002, 2.0, 6), ("a", 2003, 4.0, 7)],
                               "municipality_id string, any int, avg_monthly_rent double, total_contracts int")
    out = X.time_features(df, difference=True).orderBy("any").collect()
    assert [r.avg_monthly_rent_lag1 for r in out] == [None, 1.0, 2.0]  # by rows, the gap is ignored
    assert [r.avg_monthly_rent_diff1 for r in out] == [None, None, 1.0]
    assert out[2].avg_monthly_rent_roll_mean3 == 1.5
    assert "income_per_capita_lag1" not in out[0].asDict()
    assert X.feature_columns(df.withColumn("comarca_name", F.lit("x"))) == ["any", "comarca_name", "total_contracts"]
    assert X.fixed_feature_columns(df, ["total_contracts", "no"], "any", ["no2"]) == ["total_contracts", "any"]


def test_time_split(spark, rows):
    df = spark.createDataFrame([(y,) for y in (2018, 2019, 2019, 2021, 2022, None)], "y int")
    assert rows(O.time_split(df, "y")) == [(2018, "train"), (2019, "train"), (2019, "train"), (2021, "validation"), (2022, "test")]
    assert rows(O.time_split(df, "y", 2), "split") == [("test",), ("train",), ("train",), ("train",), ("train",)]
    report = {r.split: (r.rows, r.min_year, r.max_year, r.overlaps) for r in O.split_report(O.time_split(df, "y"), "y").collect()}
    assert report["train"] == (3, 2018, 2019, False)
    with pytest.raises(ValueError):
        O.time_split(df.filter("y < 2020"), "y")


def test_scaler_and_categories(spark, rows):
    train = spark.createDataFrame([(1.0, 5.0, "b"), (3.0, 5.0, "a"), (None, 5.0, None)], "x double, c double, k string")
    scaler = X.fit_scaler(train, ["x", "c"])
    assert scaler.stats["x"] == (2.0, 1.0) and scaler.stats["c"] == (5.0, 0.0)
    assert rows(X.apply_scaler(train, scaler), "x", "c") == [(None, 0.0), (-1.0, 0.0), (1.0, 0.0)]
    codes = X.fit_categories(train, "k")
    assert rows(codes) == [("a", 0), ("b", 1)]
    test = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert rows(X.encode_categories(test, codes, "k")) == [(None, None), ("a", 0), ("z", None)]


@pytest.mark.parametrize("many", [None, "right"])
def test_outer_join_keeps_null_keys_and_duplicates(spark, rows, many):
    left = spark.createDataFrame([("a", 1, "L1"), ("b", 1, "L2"), (None, 1, "L3")], "id string, y int, l string")
    right = spark.createDataFrame([("a", 1, "R1"), ("a", 1, "R2"), ("c", 1, "R3"), (None, 1, "R4")], "id string, y int, r string")
    assert rows(J.outer_on(left, right, ["id", "y"], many)) == [
        (None, 1, None, "R4"), (None, 1, "L3", None), ("a", 1, "L1", "R1"), ("a", 1, "L1", "R2"), ("b", 1, "L2", None), ("c", 1, None, "R3")]


def test_other_joins(spark, rows):
    left = spark.createDataFrame([("a", None), ("b", "n")], "id string, name string")
    right = spark.createDataFrame([("a", "m"), ("b", "x"), ("c", "y")], "id string, name string")
    assert rows(J.outer_coalesced(left, right, ["id"], ["name"])) == [("a", "m"), ("b", "n"), ("c", "y")]
    edges = spark.createDataFrame([("1", "2"), ("2", "1"), ("1", "3"), ("1", "9")], "id string, neighbor_id string")
    parents = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "A")], "id string, parent string")
    assert rows(J.derive_parent_edges(edges, parents)) == [("A", "B"), ("B", "A")]
    polys = spark.createDataFrame([(1,), (2,)], "pid int")
    stats = spark.createDataFrame([("1", 5.0)], "mid string, v double")
    assert rows(J.attach_to_polygons(polys, stats, "pid", "mid")) == [(1, "1", 5.0), (2, None, None)]
    assert rows(J.exclude_known(right.selectExpr("id s", "'p' p", "name o"), left.selectExpr("'c' s", "'p' p", "'y' o"))) == [("a", "p", "m"), ("b", "p", "x")]
