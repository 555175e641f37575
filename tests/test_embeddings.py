import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terraloom import vocab
from terraloom.functions import scoring
from terraloom.operators import embeddings as E
from terraloom.operators.ranking import count_better

TRIPLE = "s string, p string, o string"


def toy(spark, n=40):
    """Rings: every entity links to the next and to the one after."""
    rows = [(f"e{i}", "next", f"e{(i + 1) % n}") for i in range(n)] + [(f"e{i}", "skip", f"e{(i + 2) % n}") for i in range(n)]
    return spark.createDataFrame(rows, TRIPLE)


def params_of(spark, model, entities, relations, seed=0):
    rng = np.random.default_rng(seed)
    w = scoring.widths(model, 4)
    rows = [("e", i, e, rng.normal(size=w.entity).tolist()) for i, e in enumerate(entities)]
    rows += [("r", i, r, rng.normal(size=w.relation).tolist()) for i, r in enumerate(relations)]
    if w.extra:
        rows += [("x", i, r, rng.normal(size=w.extra).tolist()) for i, r in enumerate(relations)]
    return rows, spark.createDataFrame(rows, "kind string, id long, label string, vec array<double>")


@pytest.mark.parametrize("model", scoring.MODELS)
def test_gradients(model):
    rng = np.random.default_rng(1)
    w = scoring.widths(model, 4)
    parts = [rng.normal(size=(3, n)) for n in (w.entity, w.relation, w.entity)] + ([rng.normal(size=(3, w.extra))] if w.extra else [None])
    found = scoring.gradients(model, *parts)
    for k, part in enumerate(parts):
        if part is None:
            assert found[k] is None
            continue
        for j in range(part.shape[1]):
            up, down = [None if p is None else p.copy() for p in parts], [None if p is None else p.copy() for p in parts]
            up[k][:, j] += 1e-6
            down[k][:, j] -= 1e-6
            slope = (scoring.score(model, *up) - scoring.score(model, *down)) / 2e-6
            assert np.allclose(found[k][:, j], slope, atol=1e-4)


def test_index_is_dense_and_sorted(spark, rows):
    mapped, entities, relations = E.index_triples(toy(spark).repartition(4))
    labels = [(r.label, r.id) for r in entities.orderBy("id").collect()]
    assert [i for _, i in labels] == list(range(40)) and [n for n, _ in labels] == sorted(n for n, _ in labels)
    assert rows(relations) == [("next", 0), ("skip", 1)]
    by = dict(labels)
    assert (by["e3"], 0, by["e4"]) in {tuple(r) for r in mapped.collect()} and mapped.count() == 80


def test_inverses_and_split(spark):
    triples = E.add_inverses(toy(spark))
    assert triples.count() == 160 and triples.filter("p = 'next_inverse' and s = 'e1' and o = 'e0'").count() == 1
    split = E.split_triples(triples, seed=42)
    parts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(parts.values()) == 160 and parts["train"] > 100 and min(parts["validation"], parts["test"]) > 0
    train = split.filter("split = 'train'")
    assert train.select(F.explode(F.array("s", "o")).alias("e")).distinct().count() == 40
    assert train.select("p").distinct().count() == 4
    assert sorted(map(str, split.collect())) == sorted(map(str, E.split_triples(triples.repartition(3), seed=42).collect()))


def brute_ranks(model, rows, test, known):
    vec = {(k, label): np.array(v) for k, _, label, v in rows}
    names = [label for k, _, label, _ in rows if k == "e"]
    out = {}
    for s, p, o in test:
        x = vec.get(("x", p))
        sc = lambda a, b: float(scoring.score(model, vec["e", a], vec["r", p], vec["e", b], x))
        mine = sc(s, o)
        for side in ("head", "tail"):
            others = [sc(c, o) if side == "head" else sc(s, c) for c in names if ((c, p, o) if side == "head" else (s, p, c)) not in known]
            out[s, p, o, side] = 1 + sum(v > mine + 1e-12 for v in others) + sum(abs(v - mine) <= 1e-12 for v in others) / 2
    return out


@pytest.mark.parametrize("model", scoring.MODELS)
def test_ranks_match_brute_force(spark, model):
    names = [f"e{i}" for i in range(30)]
    rows, params = params_of(spark, model, names, ["p", "q"])
    rng = np.random.default_rng(2)
    known = {(f"e{a}", p, f"e{b}") for a, b, p in zip(rng.integers(0, 30, 150), rng.integers(0, 30, 150), rng.choice(["p", "q"], 150))}
    known |= {(f"e{i}", "p", "e0") for i in range(20)}  # one hot answer
    test = sorted(known)[::3]
    frame = lambda t: spark.createDataFrame(sorted(t), TRIPLE)
    got = {(r.s, r.p, r.o, r.side): r["rank"] for r in E.rank_triples(params, frame(test), frame(known), model, block_rows=7, target_rows=4, query_rows=5).collect()}
    assert got == brute_ranks(model, rows, test, known)


@pytest.mark.parametrize("model", scoring.MODELS)
@pytest.mark.parametrize("size", [1e-20, 1.0, 1e20])
def test_counts_settle_scores_closer_than_single_precision_tells(model, size):
    """Entities that differ from the answer in the tenth digit, or not at all, at every size of vectors."""
    rng = np.random.default_rng(5)
    w = scoring.widths(model, 8)
    block = np.repeat(rng.normal(size=(6, w.entity)), 5, axis=0)
    block[1::5] *= 1 + 1e-10
    block[2::5] *= 1 - 1e-10
    block *= size
    anchors = block[[0, 7]].copy()
    r = rng.normal(size=w.relation) * (size if model not in ("RotatE", "DistMult", "ComplEx") else 1.0)
    x = rng.normal(size=w.extra) / np.sqrt(w.extra) if w.extra else None
    many = lambda v, n: None if v is None else np.broadcast_to(v, (n, len(v)))
    for side in ("head", "tail"):
        score = lambda a, b: scoring.score(model, *((a, many(r, len(a)), b) if side == "tail" else (b, many(r, len(a)), a)), many(x, len(a)))
        query, answer = np.repeat([0, 1], 30), np.tile(np.arange(30), 2)
        own, known = score(anchors[query], block[answer]), [np.array([3, 9]), np.array([], int)]
        better, equal = count_better(model, side, anchors, r, x, block, known, query, own)
        for k, (q, mine) in enumerate(zip(query.tolist(), own)):
            rest = np.setdiff1d(np.arange(30), known[q])
            all_scores = score(np.repeat(anchors[[q]], len(rest), axis=0), block[rest])
            assert (better[k], equal[k]) == ((all_scores > mine).sum(), (all_scores == mine).sum())


def test_ranking_has_tasks_for_every_core_and_bounded_batches():
    assert E._batch_count(40_000, 1, 65_536, 8) == 24 and E._batch_count(2_500, 1, 65_536, 8) == 3
    assert E._batch_count(2_000_000, 10, 65_536, 12) == 31 and E._batch_count(0, 1, 65_536, 8) == 1


def test_tied_scores_get_the_middle_rank(spark):
    same = [("e", i, f"e{i}", [1.0, 1.0]) for i in range(5)] + [("r", 0, "p", [1.0, 1.0])]
    params = spark.createDataFrame(same, "kind string, id long, label string, vec array<double>")
    triples = spark.createDataFrame([("e0", "p", "e1"), ("e0", "p", "e2")], TRIPLE)
    ranks = {(r.s, r.o, r.side): r["rank"] for r in E.rank_triples(params, triples, triples, "DistMult").collect()}
    assert ranks["e0", "e1", "tail"] == 1 + 3 / 2 and ranks["e0", "e1", "head"] == 1 + 4 / 2
    values = {(r.side, r.metric): r["value"] for r in E.evaluate_kge(params, triples, triples, "DistMult").collect()}
    assert values["tail", "inverse_harmonic_mean_rank"] == pytest.approx(1 / 2.5) and values["both", "hits_at_3"] == 1.0 and values["tail", "hits_at_1"] == 0.0


@pytest.mark.parametrize("model", ["TransE", "DistMult"])
def test_score_columns_agree(spark, model):
    _, params = params_of(spark, model, ["a", "b"], ["p"])
    v = {r.label: r.vec for r in params.collect()}
    df = spark.createDataFrame([(v["a"], v["p"], v["b"])], "hv array<double>, rv array<double>, tv array<double>")
    out = E.score_triples(df, model).withColumn("jvm", E.score_column(model, "hv", "rv", "tv")).first()
    assert out.score == pytest.approx(out.jvm)


def test_training_learns(spark):
    triples = toy(spark)
    params, history = E.train_kge(triples, None, "TransE", 16, epochs=5, rate=0.3)
    assert history[-1]["loss"] < 0.8 * history[0]["loss"]
    _, entities, relations = E.index_triples(triples)
    mrr = lambda p: E.rank_triples(p, triples, triples, "TransE").agg(F.avg(1 / F.col("rank"))).first()[0]
    assert mrr(params) > 1.5 * mrr(E.init_parameters(entities, relations, "TransE", 16))


@pytest.mark.parametrize("model", ["TransH", "TransR", "RotatE", "ComplEx"])
def test_every_model_trains(spark, model):
    params, history = E.train_kge(toy(spark, 12), None, model, 4, epochs=1, rate=0.2, batches=2)
    assert len(history) == 1 and all(np.isfinite(h["loss"]) for h in history)
    sizes = {r.kind: r.n for r in params.groupBy("kind").agg(F.max(F.size("vec")).alias("n")).collect()}
    w = scoring.widths(model, 4)
    assert sizes["e"] == w.entity and sizes["r"] == w.relation and sizes.get("x", 0) == w.extra


def test_large_relation_tables_are_joined(spark, monkeypatch):
    """Beyond the size bound nothing is shipped or broadcast, and the result is the same."""
    small, a = E.train_kge(toy(spark, 10), None, "TransR", 3, epochs=1)
    monkeypatch.setattr(E, "_BROADCAST_BYTES", 0)
    large, b = E.train_kge(toy(spark, 10), None, "TransR", 3, epochs=1)
    assert a[0]["loss"] == pytest.approx(b[0]["loss"])
    flat = lambda df: sorted((r.kind, r.id, tuple(round(v, 9) for v in r.vec)) for r in df.collect())
    assert flat(small) == flat(large)


def test_early_stopping(spark):
    _, history = E.train_kge(toy(spark, 10), toy(spark, 10).limit(3), "DistMult", 2, epochs=10, rate=0.0, check_every=1, patience=2)
    assert len(history) == 3  # one best check, then two without a better one


def test_message_pass(spark, rows):
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "label string, vec array<double>")
    triples = spark.createDataFrame([("a", "p", "c"), ("b", "p", "c"), ("a", "q", "c"), ("z", "p", "c")], TRIPLE)
    assert rows(E.message_pass(vectors, triples)) == [("c", [3.0, 5.0])]
    assert rows(E.message_pass(vectors, triples, {"q": 2 * np.eye(2)})) == [("c", [4.0, 7.0])]


def test_no_test_fact_is_trained_in_reverse(spark):
    given = {tuple(r) for r in toy(spark).select("s", "p", "o").collect()}
    split = [tuple(r) for r in E.grid_split(toy(spark)).select("s", "p", "o", "split").collect()]
    held = {r[:3] for r in split if r[3] != "train"}
    train = {r[:3] for r in split if r[3] == "train"}
    assert held and held <= given and given == {t for t in held | train if not t[1].endswith("_inverse")}
    assert all((o, p + "_inverse", s) not in train for s, p, o in held)
    assert all((o, p + "_inverse", s) in train for s, p, o in train if not p.endswith("_inverse"))


def test_an_unfinished_table_is_not_stored(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert E.stored(spark, str(tmp_path / "t")).count() == 3
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert E.stored(spark, str(tmp_path / "t")) is None and E.stored(spark, str(tmp_path / "nothing")) is None


def test_grid_goes_on_after_a_failure_and_reuses_results(spark, tmp_path, rows):
    options = {"epochs": 1, "check_every": 1}
    metrics, failed = E.run_grid(spark, toy(spark, 12), [("TransE", 4), ("Nope", 4), ("TransE", 4)], str(tmp_path), **options)
    assert set(failed) == {"Nope_dim_4"} and metrics.count() == 15
    table = E.compare_experiments(metrics)
    assert table.columns == ["experiment", "IHMR", "Hits@1", "Hits@3", "Hits@5", "Hits@10"] and table.first().experiment == "TransE (d=4)"
    def never():
        raise AssertionError("a stored model is not trained again")
    assert E.train_or_load(spark, str(tmp_path / "TransE_dim_4"), never).count() > 0
    with pytest.raises(AssertionError):
        E.train_or_load(spark, str(tmp_path / "TransE_dim_4"), never, force=True)
    long = E.experiment_long(metrics)
    assert {(r.model, r.dimension) for r in long.collect()} == {("TransE", 4)} and long.count() == 5


def test_embedding_features(spark, rows):
    vectors = spark.createDataFrame([(vocab.NS + "municipality/08019", [1.0, 2.0]), (vocab.NS + "comarca/X", [3.0, 4.0])], "label string, vec array<double>")
    assert rows(E.embedding_features(vectors, 2)) == [("08019", 1.0, 2.0)]


@pytest.mark.parametrize("held", [1, 10_000])
def test_gradients_are_summed_over_the_batches_of_a_task(held):
    """One row a parameter leaves a task with room for it; without room the sums are the same."""
    rng = np.random.default_rng(3)
    vec = lambda n: pa.array(rng.normal(size=(n, 4)).tolist(), pa.list_(pa.float64()))
    ids = lambda: pa.array(rng.integers(0, 5, 30))
    batch = pa.RecordBatch.from_arrays([ids(), pa.array([0] * 30), ids(), ids(), pa.array([k % 2 == 0 for k in range(30)]), vec(30), vec(30), vec(30), vec(30)],
                                       ["h", "r", "t", "n", "corrupt_head", "hv", "tv", "nv", "rv"])
    steps = lambda batches, room: [r for out in E._batch_gradients("TransE", 1.0, E._Relations(None, False), 8, room)(iter(batches)) for r in out.to_pylist()]
    def total(rows):
        sums = {}
        for r in rows:
            sums[r["kind"], r["id"]] = sums.get((r["kind"], r["id"]), 0) + np.array(r["grad"] + [r["rows"]])
        return sums
    rows = steps([batch, batch], held)
    whole, once = total(rows), total(steps([batch], 10_000))
    assert whole.keys() == once.keys() and all(np.allclose(whole[k], 2 * once[k]) for k in whole)
    assert (len(rows) == len(whole)) == (held > 1)


def test_a_starting_vector_is_drawn_once(spark):
    """Its norm used to be computed for each of its numbers, and the vector with it: the square of its length in hashes."""
    names = spark.createDataFrame([("a", 0), ("b", 1)], "label string, id long")
    got = E.init_parameters(names, names, "TransE", 64).filter("kind = 'e'")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("xxhash64(") == 1
    drawn = names.select(E._random_vector(F.col("label"), 64, 42, 6 / 8).alias("v")).collect()
    for (v,), r in zip(drawn, got.orderBy("id").collect()):
        assert np.allclose(np.array(v) / np.linalg.norm(v), r.vec, rtol=1e-12)


@pytest.mark.parametrize("model", ["DistMult", "TransE"])
def test_counting_makes_no_copy_of_a_block(model):
    """Squares, quotients and two single-precision copies of a block took three times its memory in every task."""
    rng = np.random.default_rng(5)
    block, anchors = rng.normal(size=(60_000, 64)), rng.normal(size=(3, 64))
    known = [np.array([7, 59_999]), np.array([], np.int64), np.array([8_191, 8_192, 3])]
    query = np.array([2, 0, 1, 2])
    pair = (lambda n, e: scoring.score(model, anchors[n], relation, e)) if model == "TransE" else (lambda n, e: np.sum(anchors[n] * relation * e, axis=-1))
    relation = rng.normal(size=64)
    own = np.array([float(pair(n, block[100 + n])) for n in query])
    tracemalloc.start()
    better, equal = count_better(model, "tail", anchors, relation, None, block, known, query, own)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.1 * block.nbytes
    for k, n in enumerate(query):
        scores = np.delete(pair(n, block), known[n])
        assert abs(better[k] - (scores > own[k]).sum()) <= 1 and equal[k] <= 2
