"""Bucket-walk training against stochastic steps made one after the other."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import scoring
from terraloom.operators import embeddings as E
from terraloom.operators import walk as W


def graph(n, seed=3):
    rng = np.random.default_rng(seed)
    return sorted({(int(a), int(r), int(b)) for a, r, b in zip(rng.integers(0, n, 6 * n), rng.integers(0, 3, 6 * n), rng.integers(0, n, 6 * n))})


def start(model, n, dim, seed=1):
    rng = np.random.default_rng(seed)
    w = scoring.widths(model, dim)
    out = {"e": rng.normal(size=(n, w.entity)), "r": rng.normal(size=(3, w.relation))}
    if w.extra:
        out["x"] = rng.normal(size=(3, w.extra))
    return out


def frame(spark, parts):
    rows = [(k, i, [float(x) for x in v]) for k, m in parts.items() for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "kind string, id long, vec array<double>").repartition(3)


def draw(h, r, t, seed, epoch):
    return int(hashlib.md5(f"{h}|{r}|{t}|{seed}|{epoch}".encode()).hexdigest()[:13], 16)


def plain_epoch(parts, triples, model, size, margin, rate, epoch, seed=42):
    """Steps over the drawn order, gradient by gradient."""
    n = len(parts["e"])
    order = sorted((draw(*t, seed, epoch), *t) for t in triples)
    unit = {"TransE": "e", "TransR": "e", "TransH": "ex"}.get(model, "")
    total = 0.0
    for a in range(0, len(order), size):
        moves = {}
        for d, h, r, t in order[a:a + size]:
            other, head = (d >> 1) % n, d % 2 == 0
            h2, t2 = (other, t) if head else (h, other)
            x = parts["x"][r] if "x" in parts else None
            e, rv = parts["e"], parts["r"][r]
            loss = margin - scoring.score(model, e[h], rv, e[t], x) + scoring.score(model, e[h2], rv, e[t2], x)
            if loss <= 0:
                continue
            total += loss
            for sign, (hh, tt) in ((-1, (h, t)), (1, (h2, t2))):
                gh, gr, gt, gx = scoring.gradients(model, e[hh], rv, e[tt], x)
                for key, g in ((("e", hh), gh), (("r", r), gr), (("e", tt), gt), *([(("x", r), gx)] if x is not None else [])):
                    moves[key] = moves.get(key, 0) + sign * g
        for (kind, i), g in moves.items():
            v = parts[kind][i] - rate * g / max(1.0, np.linalg.norm(g))
            parts[kind][i] = v / np.linalg.norm(v) if kind in unit else v
    return total / len(order)


def collected(params):
    return {(r.kind, r.id): np.array(r.vec) for r in params.collect()}


@pytest.mark.parametrize("model", scoring.MODELS)
def test_one_bucket_is_plain_descent(spark, model):
    triples, parts = graph(12), start(model, 12, 4)
    walk = W.Walk(spark.createDataFrame(triples, "h long, r long, t long"), frame(spark, parts), model, 4, {"e": 12, "r": 3}, batch_size=7, rate=0.2, margin=2.0)
    for epoch in range(2):
        assert walk.epoch(epoch) == pytest.approx(plain_epoch(parts, triples, model, 7, 2.0, 0.2, epoch), rel=1e-9)
    got = collected(walk.params)
    assert len(got) == sum(map(len, parts.values()))
    for (kind, i), v in got.items():
        assert v == pytest.approx(parts[kind][i], rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("buckets", [1, 2, 3, 4, 5])
def test_every_two_buckets_meet_once(buckets):
    rounds = W.tournament(buckets)
    met = [p for r in rounds for p in r if p[0] != p[1]]
    assert sorted(met) == [(a, b) for a in range(buckets) for b in range(a + 1, buckets)]
    for r in rounds:
        of = [b for p in r for b in set(p)]
        assert len(of) == len(set(of))
    assert {b for p in rounds[0] for b in p} == set(range(buckets))


@pytest.mark.parametrize("buckets", [3])
def test_every_triple_is_trained_once_an_epoch(spark, buckets):
    triples, parts = graph(20), start("TransE", 20, 4)
    df = spark.createDataFrame(triples, "h long, r long, t long")
    walk = W.Walk(df, frame(spark, parts), "TransE", 4, {"e": 20, "r": 3}, buckets=buckets)
    placed = walk.placed.collect()
    assert sorted((r.h, r.r, r.t) for r in placed) == triples
    pairs = {p for r in walk.rounds for p in r}
    for r in placed:
        assert (r.low, r.high) in pairs and {r.h % buckets, r.t % buckets} <= {r.low, r.high}
    first = walk.epoch(0)
    for epoch in range(1, 4):
        last = walk.epoch(epoch)
    assert last < first and set(collected(walk.params)) == {(k, i) for k, m in parts.items() for i in range(len(m))}


def test_vectors_come_back_whole_from_more_than_one_bucket(spark):
    rows = [(f"e{i}", "next", f"e{(i + 1) % 30}") for i in range(30)] + [(f"e{i}", "skip", f"e{(i + 2) % 30}") for i in range(30)]
    triples = spark.createDataFrame(rows, "s string, p string, o string")
    params, history = E.train_kge(triples, None, "TransH", 4, epochs=3, buckets=3, batch_size=8)
    got = params.collect()
    assert len(history) == 3 and len(got) == 30 + 2 + 2 and {r.label for r in got if r.kind == "e"} == {f"e{i}" for i in range(30)}
    for r in got:
        if r.kind in "ex":
            assert np.linalg.norm(r.vec) == pytest.approx(1.0)


def test_replaced_tables_are_removed(spark):
    import os
    from terraloom.session import ensure_checkpoint_dir
    home = ensure_checkpoint_dir(spark).removeprefix("file:")
    count = lambda: sum(f.split("-")[0] in ("vectors", "round", "placed", "used") for f in os.listdir(home))
    before = count()
    triples = spark.createDataFrame([("a", "p", "b"), ("b", "p", "c"), ("c", "p", "a")], "s string, p string, o string")
    E.train_kge(triples, None, "TransE", 2, epochs=3)
    assert count() == before + 1  # the vectors that are returned


def test_buckets_grow_with_vectors_and_triples():
    assert W.buckets_needed(1000, 10_000, 64) == 1
    assert W.buckets_needed(10_000_000, 10_000, 64) == 153
    assert W.buckets_needed(1000, 400_000_000, 64) == 10


def test_many_triples_are_shared_among_tasks(spark):
    assert W.buckets_dealt(1000, 10_000, 64) == 1 and W.buckets_dealt(1000, 400_000_000, 64) == 10
    assert W.buckets_dealt(96_000, 3_500_000, 64) == 8  # one task made all the steps of an epoch
    buckets, pairs = 8, W.tournament(8)[0]
    triples = spark.range(400).selectExpr("cast(id % 4 as int) pair", "id % 4 + 8 * (id % 5) h", "0l r", "7 - id % 4 + 8 * (id % 5) t", "id draw")
    params = frame(spark, start("TransE", 40, 4))
    used = spark.range(4).selectExpr("cast(id as int) pair", "0l r")
    done = W.train_round(params, triples, used, pairs, buckets, "TransE", 8, 1.0, 0.1, ("e",))
    tasks = [r.n for r in done.where("kind = 'loss'").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert tasks == [1] * 4  # a pair each
