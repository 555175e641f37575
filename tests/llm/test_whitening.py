"""Whitening against numpy over the distinct vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.llm import whitening


def vectors(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(partitions)
    return df.withColumns({c: F.lit("x") for c in "x weight v made n i s component deviation of".split()})


def sample(seed, count, dim=6, spread=0.3):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(count, dim)) * spread * np.arange(1, dim + 1)).astype(np.float32)
    v[count // 2:] = v[:count - count // 2]  # half of them are copies
    v[::3] = v[0]  # and one vector holds a third
    return [(i, row.tolist()) for i, row in enumerate(v)]


def check(rows, usable, weights="one", keep=4):
    x = {}
    for i, v in usable:
        x.setdefault(i, []).append(tuple(math.floor(256 * float(np.float32(c))) for c in v))
    lists = [v for held in x.values() for v in held]
    fit = sorted(set(lists))
    w = np.array([lists.count(v) if weights == "count" else 1 for v in fit])
    n, u = int(w.sum()), np.array(fit, object)
    total = (u * w[:, None].astype(object)).sum(0)
    mean = np.array([t / n for t in total])
    c = u.astype(float) - mean
    cov = (c * w[:, None]).T @ c / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(rows) == len(lists) * min(keep, len(mean))
    for r in rows:
        k = r.component - 1
        near = [v for v in x[r.vec_id] if sum((n * a - int(s)) ** 2 for a, s in zip(v, total)) == int(r.deviation)]
        assert near and r.n == n
        if values[0] == 0:
            assert r.whitened is None and r.explained is None and r.identity_error is None
            continue
        assert r.explained == pytest.approx(max(values[k], 0) / np.trace(cov), rel=1e-9, abs=1e-12)
        assert r.identity_error < 1e-9
        if values[k] <= whitening.FLAT * values[0]:
            assert r.whitened is None
        else:
            assert any(abs(r.whitened) == pytest.approx(abs((np.array(v, float) - mean) @ axes[:, k] / np.sqrt(values[k])), rel=1e-8, abs=1e-8) for v in near)
    return cov


@pytest.mark.parametrize("weights", ["one", "count"])
def test_equals_numpy(spark, weights):
    rows = sample(1, 90)
    check(whitening.whiten(vectors(spark, rows), weights=weights).collect(), rows, weights)


def test_one_sign_for_all_rows(spark):
    rows = sample(2, 60)
    out = whitening.whiten(vectors(spark, rows))
    by = {(r.vec_id, r.component): r.whitened for r in out.collect()}
    z = np.array([[by[i, c] for c in (1, 2, 3, 4)] for i, _ in rows])
    distinct = np.unique(np.array([[math.floor(256 * c) for c in v] for _, v in rows] ), axis=0, return_index=True)[1]
    z = z[distinct]
    assert np.abs((z - z.mean(0)).T @ (z - z.mean(0)) / len(z) - np.eye(4)).max() < 1e-9


def test_left_out_and_carried_rows(spark):
    good = sample(3, 30, 5)
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [float("nan")] * 5), (904, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (905, [1.0, 2.0])]
    kept = [*good, (None, good[4][1]), (5, good[5][1]), (5, good[5][1]), (906, [0.0] * 5), (907, [-0.0] * 5)]
    out = whitening.whiten(vectors(spark, [*bad, *kept])).collect()
    check(out, kept)
    assert not {r.vec_id for r in out} & {r[0] for r in bad}


def test_without_variance_and_empty(spark):
    same = [(i, [1.0, 2.0, 3.0]) for i in range(7)]
    check(whitening.whiten(vectors(spark, same)).collect(), same)
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]  # one component varies
    check(whitening.whiten(vectors(spark, line)).collect(), line)
    short = [(i, [float(i * i)]) for i in range(5)]
    check(whitening.whiten(vectors(spark, short)).collect(), short)
    empty = whitening.whiten(vectors(spark, same).limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate([[3e14, 1.0, -7.0], [1.0, 2e9, 5.0], [-3e14, 100.0, 3.0], [2.0, 4.0, 9e5], [2.0, 4.0, 9e5]])]
    out = whitening.whiten(vectors(spark, rows)).collect()
    fit = sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for _, v in rows})
    total = [sum(c) for c in zip(*fit)]
    for r in out:
        v = [math.floor(256 * float(np.float32(c))) for c in rows[r.vec_id][1]]
        assert int(r.deviation) == sum((len(fit) * a - s) ** 2 for a, s in zip(v, total))


def test_packing_of_grid_vectors():
    x = np.array([[1, -2], [2 ** 15, 0], [-2 ** 31, 5], [2 ** 40, 1], [-2 ** 15, 2 ** 15 - 1]])
    packed = whitening.pack_grid(x)
    assert [len(p) for p in packed] == [4, 8, 8, 16, 4] and (whitening.unpack_grid(packed, 2) == x).all()
    assert whitening.to_grid(np.array([[1e300, -1e300, -0.5, 0.999]]), 1.0).tolist() == [[2 ** 63 - 1, -2 ** 63, -1, 0]]
