import math
import random

import pytest
from pyspark.sql import functions as F

from terraloom.operators import spatial as SP

RING = "id string, rings array<array<struct<x:double,y:double>>>"


def frame(spark, shapes):
    return spark.createDataFrame([(k, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for k, rings in shapes.items()], RING)


def square(x, y, side=1.0):
    return [[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]


def pairs(spark, shapes, tol=1.0):
    got = [tuple(r) for r in SP.spatial_neighbors(frame(spark, shapes), "id", tol).collect()]
    assert len(got) == len(set(got)) and {(b, a) for a, b in got} == set(got)
    return {p for p in got if p[0] < p[1]}


def test_edges_corners_gaps_and_holes(spark):
    big = square(1000, 1000, 100)
    shapes = {
        "a": square(0, 0, 10), "b": square(10, 0, 10), "c": square(20, 10, 10), "near": square(30.9, 10, 10), "far": square(42, 10, 10),
        "outer": big, "inner": square(1040, 1040, 5),
        "ring": [square(2000, 2000, 100)[0], square(2010, 2010, 80)[0]], "lake": square(2040, 2040, 5), "shore": square(2010.5, 2050, 5),
        "cross1": [[(3000, 3000), (3100, 3000), (3100, 3010), (3000, 3010)]], "cross2": [[(3050, 2950), (3060, 2950), (3060, 3050), (3050, 3050)]],
        "multi": [square(-500, 0)[0], square(1060, 1060, 2)[0]]}
    assert pairs(spark, shapes) == {("a", "b"), ("b", "c"), ("c", "near"), ("inner", "outer"), ("ring", "shore"), ("cross1", "cross2"), ("multi", "outer")}
    assert ("far", "near") in pairs(spark, shapes, 1.1 + 1e-9)


def _gap(a, b):
    """Distance of two axis-parallel rectangles."""
    dx = max(b[0] - a[2], a[0] - b[2], 0)
    dy = max(b[1] - a[3], a[1] - b[3], 0)
    return math.hypot(dx, dy)


@pytest.mark.parametrize("seed", [1, 2])
def test_rectangles_of_very_different_sizes(spark, seed):
    rng = random.Random(seed)
    boxes = {}
    for i in range(120):
        w, h = (10 ** rng.uniform(-1, 3) for _ in range(2))
        x, y = rng.uniform(-2000, 2000), rng.uniform(-2000, 2000)
        boxes[f"{i:03d}"] = (x, y, x + w, y + h)
    shapes = {k: [[(a, b), (c, b), (c, d), (a, d)]] for k, (a, b, c, d) in boxes.items()}
    want = {(i, j) for i in boxes for j in boxes if i < j and _gap(boxes[i], boxes[j]) <= 1.0}
    assert len(want) >= 10
    assert pairs(spark, shapes) == want


def test_crowd_of_small_shapes_next_to_one_large(spark):
    """A crowd that would share one cell of a uniform grid does not compare all with all."""
    shapes = {f"s{i:03d}": square(i % 20 * 5, i // 20 * 5, 1) for i in range(400)} | {"big": square(0, 0, 4096)}
    df = frame(spark, shapes)
    assert SP.candidate_pairs(df, "id").count() < 400 * 5
    assert len(pairs(spark, shapes)) == 400


def _disc(cx, cy, r, n):
    return [[(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k in range(n)]]


def test_two_polygons_of_a_hundred_thousand_edges_lie_in_no_row(spark):
    """Once taken apart, what is shuffled are single edges; the discs touch in one place only."""
    shapes = {"west": _disc(0, 0, 1e5, 100_000), "east": _disc(2e5 + 0.5, 0, 1e5, 100_000), "isle": _disc(0, 0, 50, 12), "off": _disc(0, 1e6, 1e5, 1000)}
    df = frame(spark, shapes)
    assert pairs(spark, shapes) == {("east", "west"), ("isle", "west")}
    edges = SP.ring_edges(df, "id")
    assert edges.count() == 201_012 and not any("array" in t for _, t in edges.dtypes)
    plan = SP.spatial_neighbors(df)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_many_rings_inside_and_between_the_walls_of_one(spark):
    walls = [square(0, 0, 100)[0], square(10, 10, 30)[0], square(60, 60, 30)[0]]
    inside = {f"i{k}": square(45 + k, 45 + k, 0.5) for k in range(8)}
    holes = {f"h{k}": square(15 + 2 * k, 20, 0.5) for k in range(8)}
    got = pairs(spark, {"w": walls} | inside | holes, tol=0.1)
    assert {p for p in got if "w" in p} == {(k, "w") for k in inside}


def test_points_empty_rings_and_missing_coordinates(spark):
    df = spark.createDataFrame([
        ("point", [[(5.0, 5.0)]]), ("box", [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]]), ("none", []), ("null", None),
        ("hollow", [[]]), ("part", [[(20.0, 20.0), (None, 1.0), (10.5, 10.0)]]), (None, [[(5.0, 5.0)]])], RING)
    got = {tuple(r) for r in SP.spatial_neighbors(df).collect()}
    assert got == {("point", "box"), ("box", "point"), ("part", "box"), ("box", "part")}


def test_nothing_in_nothing_out(spark):
    assert SP.spatial_neighbors(frame(spark, {"a": square(0, 0)}).filter("id = 'x'"), "id").count() == 0


def test_edges_never_travel_through_the_driver(spark):
    """The estimate of a few polygons says nothing about their edges, so no join may be a broadcast."""
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(F.col("c_name").alias("id"), F.expr(
        "array(transform(sequence(0, 3), k -> struct(double(c_custkey + k % 2) x, double(k div 2) y))) rings"))
    plan = SP.spatial_neighbors(df)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 3


def test_rows_of_one_id_are_one_polygon(spark):
    """Two parts inside the same polygon must not count as one ray with two crossings."""
    outer, inner = square(0, 0, 100), [square(20, 20, 5), square(60, 60, 5)]
    df = frame(spark, {"outer": outer}).unionByName(frame(spark, {"m": inner[0]})).unionByName(frame(spark, {"m": inner[1]}))
    assert {tuple(r) for r in SP.spatial_neighbors(df).collect()} == {("m", "outer"), ("outer", "m")}
