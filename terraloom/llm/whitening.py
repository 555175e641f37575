"""Whitening of embeddings, fitted on distinct vectors with multiplicities.

Components of vectors are put on a grid: every entry becomes the whole number ``floor(scale * c)``.
Equal grid vectors are grouped; the fit list is each distinct one with a weight, its count or one.
Sums over the fit list give the mean, and a weighted matrix product of centred rows the covariance,
task by task, merged by sums. Its unit eigenvectors, by falling eigenvalue, are the components.
Each distinct vector is whitened once and joined back to the rows it stands for, so that copies
cost no arithmetic, and a vector shared by very many rows is one row on its side of the join.

Rows whose vector is null, empty or holds a null or non-finite entry are left out, as are, where
lengths differ, vectors of another than the most frequent length (the longer at a tie). Entries
beyond the 64-bit range become its ends. Null and repeated ids are carried along, one result per row
and component. Components number at most the vector's length. A component without variance (an
eigenvalue of at most ``1e-10`` of the largest) has a null ``whitened``; without any variance
``explained`` and ``identity_error`` are null too. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import map_arrow, quoted
from terraloom.session import materialise

FLAT = 1e-10  # share of the largest eigenvalue up to which a component has no variance
_ROWS = 8192  # vectors decoded at once
_OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def usable(vector: str):
    """Whether every entry of the vector is a number."""
    v = F.col(quoted(vector)).cast("array<double>")
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def to_grid(v: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * v)`` as 64-bit integers, beyond their range its ends."""
    x = np.floor(scale * v)
    top = x >= 2.0 ** 63
    return np.where(top, np.iinfo(np.int64).max, np.maximum(np.where(top, 0.0, x), -2.0 ** 63).astype(np.int64))


def pack_grid(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of 2, 4 or 8 bytes an entry; as all rows have one length, equal bytes mean equal rows."""
    low, high = x.min(1), x.max(1)
    width = np.full(len(x), 8)
    width[(low >= -2 ** 31) & (high < 2 ** 31)] = 4
    width[(low >= -2 ** 15) & (high < 2 ** 15)] = 2
    return [row.astype(f"<i{w}").tobytes() for row, w in zip(x, width.tolist())]


def unpack_grid(packed: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(packed), dim), np.int64)
    widths = np.array([len(p) // dim for p in packed])
    for w in (2, 4, 8):
        at = np.flatnonzero(widths == w)
        if len(at):
            out[at] = np.frombuffer(b"".join(packed[i] for i in at.tolist()), f"<i{w}").reshape(-1, dim)
    return out


def _parts(column: pa.Array):
    """Values of a column, so many at once."""
    for a in range(0, len(column), _ROWS):
        yield a, column.slice(a, _ROWS).to_pylist()


def weighted_covariance(rows: DataFrame, value: str, weight: str, decode: Callable[[list], np.ndarray], dim: int, total: int, centre: np.ndarray) -> np.ndarray:
    """The covariance of the vectors in ``value`` about ``centre``, divisor ``total``, centred before multiplying.

    Each task multiplies its own rows; only ``dim * dim`` sums a task are shuffled, and as many come to the driver.
    """
    def products(batches):
        made = np.zeros((dim, dim))
        for batch in batches:
            weights = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            for a, values in _parts(batch.column(0)):
                centred = decode(values) - centre
                made += (centred * weights[a:a + len(centred), None]).T @ centred
        for i in range(dim):
            yield i, made[i, i:].tolist()

    sums = map_arrow(rows.select(value, weight), products, "i int, made array<double>", i=pa.int32(), made=pa.list_(pa.float64())) \
        .select("i", F.posexplode("made").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s"))
    out = np.zeros((dim, dim))
    for i, j, s in sums.collect():
        out[i, i + j] = out[i + j, i] = s
    return out / total


def components(covariance: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and as rows their unit eigenvectors, of which the largest entry is positive."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:keep]
    rows = vectors.T[order]
    sign = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(1)])
    return np.maximum(values[order], 0.0), rows * sign[:, None]


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", keep: int = 4, scale: float = 256.0, weights: str = "one") -> DataFrame:
    """One row per row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``n`` is the weight of the fit list: its length with ``weights="one"``, the rows it stands for
    with ``"count"``. ``deviation`` is the exact sum of ``(n*x - S)^2`` over the dimensions, ``S``
    being the weighted sums; ``identity_error`` is the largest absolute entry of the measured
    covariance of ``whitened`` minus the identity, over the components with variance. A deviation of
    more than 38 digits is null.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights is 'one' or 'count'")
    spark = vectors.sparkSession
    rows = vectors.where(usable(vector)).select(F.col(quoted(id_column)).cast("long").alias("vec_id"), F.col(quoted(vector)).cast("array<double>").alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return spark.createDataFrame([], _OUT)
    dim = lengths["n"]
    keep = min(keep, dim)

    def grid(batches):
        for batch in batches:
            ids, v = batch.column(0).to_pylist(), batch.column(1)
            yield from zip(ids, pack_grid(to_grid(v.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), scale)) if ids else [])

    gridded = materialise(map_arrow(rows.where(F.size("v") == dim), grid, "vec_id long, x binary", vec_id=pa.int64(), x=pa.binary()), "grid")
    weight = F.count(F.lit(1)) if weights == "count" else F.lit(1).cast("long")
    distinct = materialise(gridded.groupBy("x").agg(weight.alias("weight")), "distinct")

    def sums(batches):
        total = [0] * dim
        for batch in batches:
            of = batch.column(1).to_numpy(zero_copy_only=False)
            for a, packed in _parts(batch.column(0)):
                x, w = unpack_grid(packed, dim), of[a:a + len(packed)]
                wide = int(np.abs(x.astype(float)).max()) * int(w.sum()) >= 2 ** 62
                made = (x.astype(object) * w.astype(object)[:, None]).sum(0) if wide else (x * w[:, None]).sum(0)
                total = [t + int(s) for t, s in zip(total, made)]
        yield from ((i, Decimal(t)) for i, t in enumerate(total))

    n = distinct.agg(F.sum("weight")).first()[0]
    exact = map_arrow(distinct, sums, "i int, s decimal(38,0)", i=pa.int32(), s=pa.decimal128(38)).groupBy("i").agg(F.sum("s").alias("s")).collect()
    total = [0] * dim
    for i, s in exact:
        total[i] = int(s)
    mean = np.array([t / n for t in total])
    covariance = weighted_covariance(distinct, "x", "weight", lambda packed: unpack_grid(packed, dim).astype(float), dim, n, mean)
    values, axes = components(covariance, keep)
    trace = float(np.trace(covariance))
    vary = np.flatnonzero(values > FLAT * values[0]) if trace > 0 else np.array([], int)
    project = (axes[vary] / np.sqrt(values[vary])[:, None]).T

    def each(batches):
        for batch in batches:
            for _, packed in _parts(batch.column(0)):
                x = unpack_grid(packed, dim)
                w = (x - mean) @ project
                # n*x - S stays inside 64 bits, and so does its square summed, or else is done in whole numbers of any size.
                far = np.abs(n * x.astype(float) - np.array([float(t) for t in total])).max(initial=0.0)
                near = far < 2.0 ** 62 and float(n) * float(np.abs(x.astype(float)).max(initial=0.0)) < 2.0 ** 62 and dim * far * far < 2.0 ** 62
                if near:
                    off = n * x - np.array(total, np.int64)
                    deviation = (off * off).sum(1).tolist()
                else:
                    off = n * x.astype(object) - np.array(total, object)
                    deviation = (off * off).sum(1).tolist()
                for p, d, c in zip(packed, deviation, w.tolist()):
                    yield p, Decimal(int(d)) if int(d) < 10 ** 38 else None, c

    done = materialise(map_arrow(distinct.select("x"), each, "x binary, deviation decimal(38,0), made array<double>",
                                 x=pa.binary(), deviation=pa.decimal128(38), made=pa.list_(pa.float64())), "whitened")
    error = None
    if len(vary):
        measured = done.join(distinct, "x") if weights == "count" else done.withColumn("weight", F.lit(1))
        one = measured.select(*[F.sum(F.col("made")[i] * F.col("weight")).alias(f"c{i}") for i in range(len(vary))]).first()
        check = weighted_covariance(measured, "made", "weight", lambda made: np.array(made, float).reshape(-1, len(vary)), len(vary), n, np.array(one) / n)
        error = float(np.abs(check - np.eye(len(vary))).max())
    place = {int(c): i for i, c in enumerate(vary)}
    table = F.array(*[F.struct(F.lit(c + 1).cast("int").alias("component"),
                               (F.get("made", F.lit(place[c])) if c in place else F.lit(None).cast("double")).alias("whitened"),
                               F.lit(float(values[c] / trace) if trace > 0 else None).cast("double").alias("explained")) for c in range(keep)])
    joined = gridded.join(done, "x").select("vec_id", "deviation", F.explode(table).alias("of"))
    return joined.select("vec_id", "of.component", F.lit(n).cast("long").alias("n"), "deviation", "of.whitened", "of.explained",
                         F.lit(error).cast("double").alias("identity_error"))
