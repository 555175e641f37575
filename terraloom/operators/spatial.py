"""Neighbouring polygons: grid equi-joins of single edges, and one ray per ring for containment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.session import cut_lineage

# Two opposite corners of what lies in the grid: the ends of an edge, or of a box's diagonal.
_ENDS = ("px", "py", "qx", "qy")


def _span(p: str, q: str, tol: float, side: str = "") -> tuple[Column, Column]:
    """Least and greatest coordinate, widened by half the tolerance."""
    p, q, half = F.col(side + p), F.col(side + q), F.lit(tol / 2)
    return F.least(p, q) - half, F.greatest(p, q) + half


def _level(extent: Column) -> Column:
    """The grid level at which the extent fits one cell side; every second power of two is a level."""
    return (F.ceil(F.log2(F.greatest(extent, F.lit(1e-9))) / 2) * 2).cast("int")


def _levelled(items: DataFrame, tol: float) -> DataFrame:
    (x0, x1), (y0, y1) = _span("px", "qx", tol), _span("py", "qy", tol)
    return items.withColumn("level", _level(F.greatest(x1 - x0, y1 - y0)))


def _size() -> Column:
    return F.pow(F.lit(2.0), F.col("level"))


def _cells_between(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(F.floor(low / _size()).cast("long"), F.floor(high / _size()).cast("long")))


def _in_cells(items: DataFrame, tol: float) -> DataFrame:
    """One row per cell of its level that an item touches: four at most at its own level or a coarser one."""
    return (items.withColumn("cx", _cells_between(*_span("px", "qx", tol)))
            .withColumn("cy", _cells_between(*_span("py", "qy", tol))))


def _levels(items: DataFrame) -> list[int]:
    """The levels that occur: a few dozen numbers, fetched when the plan is built."""
    return sorted(r[0] for r in items.select("level").distinct().collect()) or [0]


def _other(items: DataFrame, columns) -> DataFrame:
    return items.select("level", "cx", "cy", *[F.col(c).alias(f"b_{c}") for c in columns])


def _by_key(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join by a shuffle of both sides.

    Estimates take exploded rows for as few as the polygons they come from, so that Spark would send
    all edges through the driver.
    """
    return left.join(right.hint("merge"), list(on))


def _meetings(items: DataFrame, tol: float) -> DataFrame:
    """Rows of two items of different ids whose boxes are within ``tol``; each two meet once.

    An item belongs to the level at which it fits one cell side, hence to at most four cells. It is
    stored there and looks for partners there and at the coarser levels that occur. Small items
    therefore never share one crowded cell just because others are large, and a large one is not
    cut into many cells. Two that meet in several cells are reported only in the cell of the lower
    corner of their boxes' overlap, which needs no distinct.
    """
    upward = F.filter(F.array(*[F.lit(v) for v in _levels(items)]), lambda v: v >= F.col("level"))
    probes = _in_cells(items.withColumn("own", F.col("level")).withColumn("level", F.explode(upward)), tol)
    stored = _other(_in_cells(items, tol), ("id", *_ENDS))
    (x0, x1), (y0, y1) = _span("px", "qx", tol), _span("py", "qy", tol)
    (u0, u1), (v0, v1) = _span("px", "qx", tol, "b_"), _span("py", "qy", tol, "b_")
    return (_by_key(probes, stored, ["level", "cx", "cy"])
            .filter((F.col("id") < F.col("b_id")) | (F.col("own") < F.col("level")) & (F.col("id") != F.col("b_id")))
            .filter((x0 <= u1) & (u0 <= x1) & (y0 <= v1) & (v0 <= y1))
            .filter((F.floor(F.greatest(x0, u0) / _size()) == F.col("cx")) & (F.floor(F.greatest(y0, v0) / _size()) == F.col("cy"))))


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(F.least("id", "b_id").alias("a"), F.greatest("id", "b_id").alias("b"))


def ring_edges(polys: DataFrame, key: str) -> DataFrame:
    """``id, ring, at, px, py, qx, qy``: every edge of every ring, the last one back to its first point.

    ``ring`` is a number of its own for every ring, also where several rows bear one id. A ring of
    one point is one edge of no length. Points without both coordinates are left out.
    """
    points = F.filter("points", lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    rings = polys.select(F.col(key).alias("id"), F.explode("rings").alias("points")).select(
        "id", F.monotonically_increasing_id().alias("ring"), points.alias("points"))
    following = F.concat(F.slice("points", 2, F.size("points")), F.slice("points", 1, 1))
    edge = F.zip_with("points", following, lambda p, q: F.struct(
        p["x"].alias("px"), p["y"].alias("py"), q["x"].alias("qx"), q["y"].alias("qy")))
    return rings.filter(F.size("points") > 0).select("id", "ring", F.posexplode(edge).alias("at", "e")).select(
        "id", "ring", "at", "e.*")


def _extents(edges: DataFrame, *by: str) -> DataFrame:
    """The box of each polygon or ring, by its lower and upper corner."""
    return edges.groupBy(*by).agg(
        F.min(F.least("px", "qx")).alias("px"), F.min(F.least("py", "qy")).alias("py"),
        F.max(F.greatest("px", "qx")).alias("qx"), F.max(F.greatest("py", "qy")).alias("qy"))


def candidate_pairs(polys: DataFrame, key: str, tol: float = 1.0) -> DataFrame:
    """Unordered pairs ``a, b`` whose boxes are within ``tol`` of each other, each once."""
    return _ordered(_meetings(_levelled(_extents(ring_edges(polys, key), "id"), tol), tol))


# --- exact tests of single edges ----------------------------------------------------------------

def _near(point: Sequence[str], edge: Sequence[str], tol: float) -> Column:
    """Whether a point is at most ``tol`` from an edge: from its nearer end, or from the line between its ends."""
    px, py = (F.col(c) for c in point)
    ax, ay, bx, by = (F.col(c) for c in edge)
    dx, dy, vx, vy, wx, wy = bx - ax, by - ay, px - ax, py - ay, px - bx, py - by
    along, length, across, most = vx * dx + vy * dy, dx * dx + dy * dy, vx * dy - vy * dx, F.lit(float(tol) ** 2)
    return (F.when(along <= 0, vx * vx + vy * vy <= most).when(along >= length, wx * wx + wy * wy <= most)
            .otherwise(across * across <= most * length))


def _side(o: Sequence[str], p: Sequence[str], q: Sequence[str]) -> Column:
    (ox, oy), (ax, ay), (bx, by) = ([F.col(c) for c in v] for v in (o, p, q))
    return (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)


def _touching(edges: DataFrame, tol: float) -> DataFrame:
    """Pairs of polygons of which two edges cross or come within the tolerance.

    Every point of a closed ring begins one edge, so the first points of both edges are enough.
    """
    mine, other = list(_ENDS), [f"b_{c}" for c in _ENDS]
    (a1, a2), (b1, b2) = (mine[:2], mine[2:]), (other[:2], other[2:])
    near = _near(a1, other, tol) | _near(b1, mine, tol)
    cross = (_side(a1, a2, b1) * _side(a1, a2, b2) < 0) & (_side(b1, b2, a1) * _side(b1, b2, a2) < 0)
    met = _meetings(_levelled(edges.select("id", *_ENDS), tol), tol)
    return _ordered(met.filter(near | cross)).distinct()


def _containing(edges: DataFrame) -> DataFrame:
    """Pairs of which a ring's first point lies inside the other polygon, by the even-odd rule.

    Points meet boxes of rings in the cells of the boxes: a ring whose box does not hold the point is
    crossed an even number of times, and parts of a polygon that lie far apart share no large box.
    The ray of a point inside a box then meets that ring's edges at its height: an edge is stored in
    the one or two strips of its own height's level, and a ray looks into one strip of each level.
    """
    boxes = _levelled(_extents(edges, "id", "ring"), 0.0)
    every = F.explode(F.array(*[F.lit(v) for v in _levels(boxes)]))
    firsts = (edges.filter("at = 0").select("id", "ring", "px", "py", every.alias("level"))
              .withColumns({"cx": F.floor(F.col("px") / _size()).cast("long"), "cy": F.floor(F.col("py") / _size()).cast("long")}))
    boxed = (_by_key(firsts, _other(_in_cells(boxes, 0.0), ("id", "ring", *_ENDS)), ["level", "cx", "cy"])
             .filter((F.col("id") != F.col("b_id")) & F.col("px").between(F.col("b_px"), F.col("b_qx"))
                     & F.col("py").between(F.col("b_py"), F.col("b_qy")))
             .select("id", "ring", "px", "py", "b_id", "b_ring"))
    low, high = _span("py", "qy", 0.0)
    walls = edges.filter("py != qy").withColumn("level", _level(high - low))
    strips = walls.withColumn("cy", _cells_between(low, high)).select(
        "level", "cy", F.col("ring").alias("b_ring"), *[F.col(c).alias(f"b_{c}") for c in _ENDS])
    rays = boxed.withColumn("level", F.explode(F.array(*[F.lit(v) for v in _levels(walls)]))).withColumn(
        "cy", F.floor(F.col("py") / _size()).cast("long"))
    spans = (F.col("b_qy") > F.col("py")) != (F.col("b_py") > F.col("py"))
    at = F.col("b_px") + (F.col("py") - F.col("b_py")) * (F.col("b_qx") - F.col("b_px")) / (F.col("b_qy") - F.col("b_py"))
    crossings = _by_key(rays, strips, ["b_ring", "level", "cy"]).filter(spans & (F.col("px") < at)).groupBy("id", "ring", "b_id").agg(
        F.count(F.lit(1)).alias("n"))
    return _ordered(crossings.filter(F.col("n") % 2 == 1))


def spatial_neighbors(polys: DataFrame, key: str = "id", tol: float = 1.0) -> DataFrame:
    """Ordered pairs ``id, neighbor_id`` of different polygons at most ``tol`` apart.

    ``polys`` has rows of an id with ``rings``; rows of one id are one polygon. The rings are taken apart into edges, which are
    written once, as several scans use them; from there on no row holds more than one edge, so a
    polygon of any size is spread over all tasks. Without crossing edges a ring lies inside the
    other polygon whole or not at all, so one point of each ring decides. Polygons without points
    have no neighbours.
    """
    tasks = int(polys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = cut_lineage(ring_edges(polys, key).repartition(tasks, "id", "ring", "at"))  # also those of one large polygon
    near = _touching(edges, tol).union(_containing(edges)).distinct()
    both = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("neighbor_id")),
                   F.struct(F.col("b").alias("id"), F.col("a").alias("neighbor_id")))
    return near.select(F.inline(both))
