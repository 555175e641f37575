"""Graph embeddings: indexing, splitting, training, ranking and use as features."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from terraloom import vocab
from terraloom.functions import scoring
from terraloom.functions.columns import lookup
from terraloom.operators.aggregate import metrics_wide
from terraloom.operators.ranking import count_better
from terraloom.operators.walk import Walk, draws
from terraloom.session import cut_lineage, remove_table

TRIPLE = ["s", "p", "o"]
_BROADCAST_BYTES = 64 * 1024 * 1024
_BROADCAST_NAMES = 100_000  # relations whose ids are sent to every task
_COVER_ROWS = 500_000  # triples of which a task sorts the members
_UNIT_MODELS = ("TransE", "TransH", "TransR")  # entity vectors are kept at length one


# --- indexing and splitting -------------------------------------------------------------------

def dense_ids(df: DataFrame, col: str, out: str = "id") -> DataFrame:
    """Distinct values with consecutive ids from 0 in sorted order.

    The sorted values are materialised, numbered within each partition, and shifted by the sizes
    of the partitions before: no task sees all of them.
    """
    values = cut_lineage(
        df.select(F.col(col)).filter(F.col(col).isNotNull()).distinct()
        .repartitionByRange(col).sortWithinPartitions(col))
    local = values.withColumn("_m", F.monotonically_increasing_id()).select(
        col, F.shiftright("_m", 33).alias("_part"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_pos"))
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))
    return local.join(F.broadcast(before), "_part").select(col, (F.col("_base") + F.col("_pos")).cast("long").alias(out))


def index_triples(triples: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Triples as ids ``h, r, t``, the entities ``label, id`` and the relations ``label, id``.

    Few relations hold all triples, so that a shuffle by them would make tasks of a whole relation: theirs
    are broadcast up to a bound. Entities are met by a shuffle.
    """
    entities = dense_ids(triples.select(F.explode(F.array("s", "o")).alias("label")), "label")
    relations = dense_ids(triples.select(F.col("p").alias("label")), "label")
    named = lambda table, key, out: table.select(F.col("label").alias(key), F.col("id").alias(out))
    kinds = named(relations, "p", "r")
    mapped = (triples.select(*TRIPLE).distinct()
              .join(F.broadcast(kinds) if relations.count() <= _BROADCAST_NAMES else kinds, "p")
              .join(named(entities, "s", "h").hint("merge"), "s")
              .join(named(entities, "o", "t").hint("merge"), "o").select("h", "r", "t"))
    return mapped, entities, relations


def add_inverses(triples: DataFrame) -> DataFrame:
    """The triples and, for each, its reverse under ``<predicate>_inverse``."""
    return triples.select(*TRIPLE).unionByName(
        triples.select(F.col("o").alias("s"), F.concat("p", F.lit("_inverse")).alias("p"), F.col("s").alias("o")))


def split_triples(triples: DataFrame, weights: Sequence[int] = (8, 1, 1), seed: int = 42) -> DataFrame:
    """Column ``split``: train, validation or test by the MD5 of the triple and the seed.

    One triple of every entity and of every relation is always in train, so nothing is ranked
    that was never trained. The choice is the least triple each, found by a combining aggregate. An
    aggregate of texts sorts its rows, so the distinct triples are written once and dealt to as many
    tasks as their number needs.
    """
    rows = cut_lineage(triples.select(*TRIPLE).distinct())
    tasks = max(1, math.ceil(rows.count() / _COVER_ROWS))
    digest = F.md5(F.concat_ws("\t", *TRIPLE, F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % sum(weights)
    row = F.struct(*TRIPLE)
    member = F.explode(F.array(
        F.struct(F.lit("e").alias("kind"), F.col("s").alias("name")),
        F.struct(F.lit("e").alias("kind"), F.col("o").alias("name")),
        F.struct(F.lit("r").alias("kind"), F.col("p").alias("name")))).alias("member")
    cover = (rows.repartition(tasks, *TRIPLE).select(member, row.alias("t")).groupBy("member").agg(F.min("t").alias("t"))
             .select("t.*").distinct().withColumn("_cover", F.lit(True)))
    drawn = F.when(bucket < weights[0], "train").when(bucket < weights[0] + weights[1], "validation").otherwise("test")
    return rows.join(cover.hint("merge"), TRIPLE, "left").select(
        *TRIPLE, F.when(F.col("_cover"), "train").otherwise(drawn).alias("split"))


# --- scores -------------------------------------------------------------------------------------

def score_column(model: str, h: Column | str, r: Column | str, t: Column | str) -> Column:
    """TransE or DistMult score of array columns, inside the JVM."""
    h, r, t = (F.col(c) if isinstance(c, str) else c for c in (h, r, t))
    double = lambda v: F.transform(v, lambda e: e.cast("double"))
    zipped = F.arrays_zip(double(h).alias("h"), double(r).alias("r"), double(t).alias("t"))
    total = lambda term: F.aggregate(zipped, F.lit(0.0), lambda acc, z: acc + term(z))
    if model == "DistMult":
        return total(lambda z: z["h"] * z["r"] * z["t"])
    if model == "TransE":
        gap = lambda z: z["h"] + z["r"] - z["t"]
        return -F.sqrt(total(lambda z: gap(z) * gap(z)))
    raise ValueError(f"no column form for {model}; use score_triples")


def _stack(series: pd.Series) -> np.ndarray:
    return np.array(series.tolist(), dtype=float)


def score_triples(df: DataFrame, model: str, h: str = "hv", r: str = "rv", t: str = "tv",
                  x: str | None = None, out: str = "score") -> DataFrame:
    """Column with the score of vector columns under any of the models."""
    @F.pandas_udf("double")
    def run(hv: pd.Series, rv: pd.Series, tv: pd.Series, xv: pd.Series) -> pd.Series:
        extra = _stack(xv) if x else None
        return pd.Series(scoring.score(model, _stack(hv), _stack(rv), _stack(tv), extra))
    return df.withColumn(out, run(h, r, t, F.col(x) if x else F.col(r)))


# --- training -----------------------------------------------------------------------------------

def _random_vector(key: Column, size: int, seed: int, scale: float) -> Column:
    """Vector of hashed uniform numbers in [-scale, scale]; the same for the same key and seed."""
    if not size:
        return F.array().cast("array<double>")
    grain = 1 << 24
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: (
        F.pmod(F.xxhash64(key, j, F.lit(seed)), F.lit(grain)).cast("double") / (grain / 2) - 1) * scale)


def init_parameters(entities: DataFrame, relations: DataFrame, model: str, dim: int,
                    seed: int = 42) -> DataFrame:
    """Starting vectors as ``kind, id, label, vec`` (kinds: e, r and, where used, x)."""
    size = scoring.widths(model, dim)
    bound = 6 / math.sqrt(dim)
    vector = lambda n, s: _random_vector(F.col("label"), n, s, bound)
    # The translation models start from unit vectors, as their distances compare them.
    start = (lambda n, s: _normalised(vector(n, s))) if model in _UNIT_MODELS else vector
    parts = [entities.select(F.lit("e").alias("kind"), "id", "label", start(size.entity, seed).alias("vec")),
             relations.select(F.lit("r").alias("kind"), "id", "label", start(size.relation, seed + 1).alias("vec"))]
    if model == "TransH":
        parts.append(relations.select(F.lit("x").alias("kind"), "id", "label",
                                      _normalised(vector(size.extra, seed + 2)).alias("vec")))
    if model == "TransR":
        unit = F.transform(F.sequence(F.lit(0), F.lit(size.extra - 1)),
                           lambda j: F.when(j % (dim + 1) == 0, 1.0).otherwise(0.0))
        parts.append(relations.select(F.lit("x").alias("kind"), "id", "label", unit.alias("vec")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _normalised(v: Column) -> Column:
    """``v`` of length one. The vector and its norm are bound once: inside a lambda they would be computed again for each number."""
    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    norm = lambda u: F.greatest(F.sqrt(F.aggregate(u, F.lit(0.0), lambda acc, e: acc + e * e)), F.lit(1e-12))
    return once(v, lambda u: once(norm(u), lambda n: F.transform(u, lambda e: e / n)))


def _vectors(params: DataFrame, kind: str, key: str, out: str, rows: int, width: int) -> DataFrame:
    """Vectors of one kind keyed for a join; broadcast only while their size is known to be small."""
    table = params.filter(F.col("kind") == kind).select(F.col("id").alias(key), F.col("vec").alias(out))
    return F.broadcast(table) if rows * width * 8 <= _BROADCAST_BYTES else table


def negative_samples(triples: DataFrame, n_entities: int, epoch: int, seed: int = 42) -> DataFrame:
    """Each ``h, r, t`` with an entity ``n`` drawn by MD5 and the side it replaces, ``corrupt_head``."""
    return draws(triples, seed, epoch).withColumns({
        "n": F.shiftright("draw", 1) % F.lit(n_entities), "corrupt_head": F.col("draw") % 2 == 0}).drop("draw")


_SLICE_NUMBERS = 4_000_000  # numbers of second relation parameters held at a time


class _Relations:
    """Relation parameters inside a task: joined columns, or a table shipped when it is small."""

    def __init__(self, table: dict[str, tuple[np.ndarray, np.ndarray]] | None, has_extra: bool):
        self.table, self.has_extra = table, has_extra

    def vectors(self, batch: pa.RecordBatch, kind: str, column: str) -> np.ndarray:
        if self.table is None:
            return _rows(batch.column(column))
        ids, rows = self.table[kind]
        return rows[np.searchsorted(ids, batch.column("r").to_numpy())]

    def of(self, batch: pa.RecordBatch):
        return self.vectors(batch, "r", "rv"), self.vectors(batch, "x", "xv") if self.has_extra else None


def _relation_table(params: DataFrame, rows: int, width: scoring.Widths):
    """Relation parameters on the driver, only while their known size stays within the bound."""
    if rows * (width.relation + width.extra) * 8 > _BROADCAST_BYTES:
        return None
    table = {}
    for kind in ("r", "x") if width.extra else ("r",):
        found = params.filter(F.col("kind") == kind).orderBy("id").select("id", "vec").collect()
        table[kind] = np.array([f["id"] for f in found]), np.array([f["vec"] for f in found], dtype=float)
    return table


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Parameter ids once each, with the sums of their gradients."""
    keys, grads = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, first = np.unique(keys[order], return_index=True)
    return keys, np.add.reduceat(grads[order], first, axis=0)


_HELD_NUMBERS = 8_000_000  # numbers of gradients that a task holds before it sums them, or lets them go


def _batch_gradients(model: str, margin: float, relations: _Relations, slice_rows: int, held_numbers: int = _HELD_NUMBERS):
    """Loss and gradients of a task's triples, summed per parameter before they leave it as far as a bound of memory allows."""
    def one(batch: pa.RecordBatch):
        h, t, n = (_rows(batch.column(c)) for c in ("hv", "tv", "nv"))
        r, x = relations.of(batch)
        head = batch.column("corrupt_head").to_numpy(zero_copy_only=False).astype(bool)
        h2, t2 = np.where(head[:, None], n, h), np.where(head[:, None], t, n)
        loss = margin - scoring.score(model, h, r, t, x) + scoring.score(model, h2, r, t2, x)
        active = loss > 0
        if not active.any():
            return 0.0, []
        pos = scoring.gradients(model, h, r, t, x)
        neg = scoring.gradients(model, h2, r, t2, x)
        ids = {c: batch.column(c).to_numpy() for c in ("h", "r", "t", "n")}
        moves = [("e", ids["h"], -pos[0]), ("e", ids["t"], -pos[2]), ("r", ids["r"], neg[1] - pos[1]),
                 ("e", np.where(head, ids["n"], ids["h"]), neg[0]), ("e", np.where(head, ids["t"], ids["n"]), neg[2])]
        if x is not None:
            moves.append(("x", ids["r"], neg[3] - pos[3]))
        kinds = dict.fromkeys(name for name, _, _ in moves)
        return float(loss[active].sum()), [(kind, _summed([(k[active], g[active]) for name, k, g in moves if name == kind])) for kind in kinds]

    def sent(kind: str, keys: np.ndarray, grads: np.ndarray, rows: int = 0) -> pa.RecordBatch:
        offsets = np.arange(len(keys) + 1, dtype=np.int32) * grads.shape[1]
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(keys)), pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(grads.ravel())),
                                           pa.array([rows] * len(keys), pa.int64())], ["kind", "id", "grad", "rows"])

    def leaving(held):
        for kind, parts in held.items():
            keys, grads = _summed(parts)
            for a in range(0, len(keys), slice_rows):
                yield sent(kind, keys[a:a + slice_rows], grads[a:a + slice_rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, rows, held = 0.0, 0, {}
        size = lambda: sum(g.size for parts in held.values() for _, g in parts)
        for whole in batches:
            for start in range(0, whole.num_rows, slice_rows):
                batch = whole.slice(start, slice_rows)
                lost, moved = one(batch)
                loss, rows = loss + lost, rows + batch.num_rows
                for kind, part in moved:
                    held.setdefault(kind, []).append(part)
                if size() > held_numbers:
                    held = {kind: [_summed(parts)] for kind, parts in held.items()}
                    if size() > held_numbers // 2:
                        yield from leaving(held)
                        held = {}
        if rows:
            yield sent("loss", np.zeros(1, np.int64), np.array([[loss]]), rows)
        yield from leaving(held)
    return run


def train_epoch(params: DataFrame, triples: DataFrame, model: str, dim: int, epoch: int, sizes: dict[str, int], *,
                seed: int = 42, margin: float = 1.0, rate: float = 0.1, batches: int = 1) -> tuple[DataFrame, float]:
    """Parameters after one epoch, materialised, and the mean loss.

    Vectors come to the triples by joins and gradients go back by one aggregate per batch of
    triples; a hot entity's gradient is summed inside each task before the shuffle.
    """
    width = scoring.widths(model, dim)
    slice_rows = max(1, _SLICE_NUMBERS // max(width.extra, width.entity))
    loss, rows = 0.0, 0
    for b in range(batches):
        part = triples if batches == 1 else triples.filter(
            F.pmod(F.xxhash64("h", "r", "t", F.lit(seed), F.lit(epoch), F.lit("batch")), F.lit(batches)) == b)
        ent = lambda key, out: _vectors(params, "e", key, out, sizes["e"], width.entity)
        joined = (negative_samples(part, sizes["e"], epoch, seed)
                  .join(ent("h", "hv"), "h").join(ent("t", "tv"), "t").join(ent("n", "nv"), "n"))
        table = _relation_table(params, sizes["r"], width)
        if table is None:
            for kind, out in (("r", "rv"), ("x", "xv")) if width.extra else (("r", "rv"),):
                joined = joined.join(params.filter(F.col("kind") == kind).select(
                    F.col("id").alias("r"), F.col("vec").alias(out)), "r")
        steps = joined.mapInArrow(
            _batch_gradients(model, margin, _Relations(table, width.extra > 0), slice_rows),
            "kind string, id long, grad array<double>, rows long")
        summed = steps.groupBy("kind", "id").agg(
            vector_to_array(Summarizer.sum(array_to_vector("grad"))).alias("grad"), F.sum("rows").alias("rows"))
        summed = cut_lineage(summed)
        seen = summed.filter(F.col("kind") == "loss").select("grad", "rows").first()
        if seen is None:
            continue
        loss, rows = loss + seen["grad"][0], rows + seen["rows"]
        # Steps are scaled down for parameters that many triples move at once, as in a mean of
        # gradients with a floor: plain sums would make hot entities diverge.
        norm = F.sqrt(F.aggregate("grad", F.lit(0.0), lambda acc, g: acc + g * g))
        step = F.transform("grad", lambda g: g * rate / F.greatest(F.lit(1.0), norm))
        moved = params.join(summed.select("kind", "id", step.alias("step")), ["kind", "id"], "left").select(
            "kind", "id", "label",
            F.when(F.col("step").isNull(), F.col("vec")).otherwise(
                F.zip_with("vec", "step", lambda v, s: v - s)).alias("vec"))
        if model in _UNIT_MODELS:
            kinds = ("e", "x") if model == "TransH" else ("e",)
            moved = moved.withColumn("vec", F.when(F.col("kind").isin(*kinds), _normalised(F.col("vec"))).otherwise(F.col("vec")))
        params = cut_lineage(moved)
    return params, loss / max(rows, 1)


def train_kge(train: DataFrame, valid: DataFrame | None = None, model: str = "TransE", dim: int = 64,
              epochs: int = 300, *, seed: int = 42, margin: float = 1.0, rate: float = 0.1, batches: int | None = None,
              batch_size: int = 64, buckets: int | None = None, check_every: int = 5, patience: int = 3) -> tuple[DataFrame, list[dict]]:
    """Train embeddings of ``s, p, o`` triples; returns parameters and the history per epoch.

    Every ``check_every`` epochs the validation triples are ranked, and training stops after
    ``patience`` checks without a better mean reciprocal rank; the best parameters are returned.
    An epoch makes a step for every ``batch_size`` triples, inside tasks that hold two buckets of
    entities (see :mod:`terraloom.operators.walk`). With ``batches`` it makes as many steps in all,
    each a mean over its part of the triples, by joins and one aggregate.
    """
    mapped, entities, relations = index_triples(train)
    mapped = cut_lineage(mapped)
    sizes = {"e": entities.count(), "r": relations.count()}
    names = cut_lineage(entities.select(F.lit("e").alias("kind"), "id", "label").unionByName(
        relations.select(F.explode(F.array(F.lit("r"), F.lit("x"))).alias("kind"), "id", "label")))
    start = cut_lineage(init_parameters(entities, relations, model, dim, seed))
    walk = None if batches else Walk(mapped, start, model, dim, sizes, seed=seed, margin=margin, rate=rate, batch_size=batch_size, buckets=buckets)
    params = start
    named = lambda p: p if batches else p.join(names, ["kind", "id"]).select("kind", "id", "label", "vec")
    history, best, best_score, waited = [], None, -1.0, 0
    for epoch in range(epochs):
        if walk:
            loss = walk.epoch(epoch, keep=best)
            params = walk.params
        else:
            params, loss = train_epoch(params, mapped, model, dim, epoch, sizes, seed=seed, margin=margin, rate=rate, batches=batches)
        history.append({"epoch": epoch, "loss": loss})
        if valid is not None and (epoch + 1) % check_every == 0:
            known = train.select(*TRIPLE).unionByName(valid.select(*TRIPLE))
            ranks = rank_triples(named(params), valid, known, model)
            mrr = ranks.agg(F.avg(1 / F.col("rank"))).first()[0] or 0.0
            history[-1]["mrr"] = mrr
            if mrr > best_score:
                if walk and best is not None:
                    remove_table(best)
                best, best_score, waited = params, mrr, 0
            else:
                waited += 1
                if waited >= patience:
                    break
    if walk:
        walk.close()
    return named(params if best is None else best), history


# --- ranking ------------------------------------------------------------------------------------

_BLOCK_ROWS = 65_536  # entities of a block; as many queries make a batch
_BATCH_LEAST = 1024  # lists of a batch that are not split for more tasks


_RANK_ROWS = "block int, batch int, kind int, q long, known array<long>, p0 binary, p1 binary, p2 binary, p3 binary, p4 binary, p5 binary, p6 binary, p7 binary, p8 binary"
_RANK_ARROW = pa.schema([("block", pa.int32()), ("batch", pa.int32()), ("kind", pa.int32()), ("q", pa.int64()), ("known", pa.list_(pa.int64())),
                         *[(f"p{i}", pa.binary()) for i in range(9)]])


def _packed_row(kind: int, number: int, *parts: np.ndarray) -> pa.RecordBatch:
    """A packed block of entities (kind 0) or batch of queries (kind 1), its other number left open."""
    row = {"block": number if kind == 0 else None, "batch": number if kind else None, "kind": kind, **{f"p{i}": p.tobytes() for i, p in enumerate(parts)}}
    return pa.RecordBatch.from_pylist([row], schema=_RANK_ARROW)


def _by_number(batches, numbers: int):
    """Rows of an Arrow stream sorted by a number, as one table per number."""
    held, now = [], None
    for batch in batches:
        of = batch.column(numbers).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            if held and now != of[a]:
                yield int(now), pa.Table.from_batches(held)
                held = []
            now = of[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield int(now), pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), -1)


def _pack_entities(batches):
    for number, rows in _by_number(batches, 0):
        ids = rows.column(1).to_numpy()
        order = np.argsort(ids)
        yield _packed_row(0, number, ids[order], _matrix(rows.column(2))[order])


def _pack_queries(has_extra: bool):
    """Rows ``batch, kind, q, side, p, vec, xv, targets, scores``: first a batch's relations, once each, then its queries."""
    def run(batches):
        for number, rows in _by_number(batches, 0):
            kind = rows.column(1).to_numpy()
            rel, ask = rows.filter(pa.array(kind == 0)), rows.filter(pa.array(kind == 1))
            if not len(rel) or not len(ask):
                continue
            names = rel.column(4).to_pylist()
            place = {n: i for i, n in enumerate(names)}
            lists = [ask.column(i).combine_chunks() for i in (7, 8)]
            yield _packed_row(1, number, ask.column(2).to_numpy(), np.array([s == "tail" for s in ask.column(3).to_pylist()]), np.array([place[p] for p in ask.column(4).to_pylist()]),
                              _matrix(ask.column(5)), _matrix(rel.column(5)), _matrix(rel.column(6)) if has_extra else np.zeros(0),
                              np.diff(lists[0].offsets.to_numpy()).astype(np.int64), lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy())
    return run


def _rank_blocks(model: str, has_extra: bool):
    """Counts of better and equal candidates per target, of each block of entities with each batch of queries."""
    def compare(entities, queries, known):
        ids = np.frombuffer(entities[0], np.int64)
        q, tail, rel = np.frombuffer(queries[0], np.int64), np.frombuffer(queries[1], bool), np.frombuffer(queries[2], np.int64)
        anchors = np.frombuffer(queries[3], float).reshape(len(q), -1)
        block = np.frombuffer(entities[1], float).reshape(len(ids), -1)
        relations = np.frombuffer(queries[4], float).reshape(len(set(rel.tolist())), -1)
        extras = np.frombuffer(queries[5], float).reshape(len(relations), -1) if has_extra else None
        counts, targets, own = np.frombuffer(queries[6], np.int64), np.frombuffer(queries[7], np.int64), np.frombuffer(queries[8], float)
        of = np.repeat(np.arange(len(q)), counts)
        left_out = [known.get(i, _NOTHING) for i in q.tolist()]
        stack = rel * 2 + tail
        for s in np.unique(stack).tolist():
            mine = np.flatnonzero(stack == s)
            wanted = np.flatnonzero(np.isin(of, mine))
            better, equal = count_better(model, "tail" if s % 2 else "head", anchors[mine], relations[s // 2], extras[s // 2] if has_extra else None, block,
                                         [np.searchsorted(ids, left_out[i]) for i in mine.tolist()], np.searchsorted(mine, of[wanted]), own[wanted])
            yield pa.RecordBatch.from_arrays([pa.array(targets[wanted]), pa.array(better), pa.array(equal)], ["target", "better", "equal"])

    def run(batches):
        now, entities, queries, known = None, None, None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if number != now:
                    if entities and queries:
                        yield from compare(entities, queries, known)
                    now, entities, queries, known = number, None, None, {}
                kind = batch.column(2)[i].as_py()
                if kind == 2:
                    known[batch.column(3)[i].as_py()] = np.array(batch.column(4)[i].as_py(), np.int64)
                else:
                    parts = [value.as_buffer() if (value := batch.column(5 + j)[i]).is_valid else None for j in range(9)]  # no copies
                    entities, queries = (parts, queries) if kind == 0 else (entities, parts)
        if entities and queries:
            yield from compare(entities, queries, known)
    return run


_NOTHING = np.array([], np.int64)


def _batch_count(lists: int, blocks: int, query_rows: int, cores: int) -> int:
    """Batches of at most ``query_rows`` lists, and enough of them that each core has three tasks while they are not tiny."""
    return max(1, math.ceil(lists / query_rows), min(math.ceil(lists / _BATCH_LEAST), math.ceil(3 * cores / blocks)))


def rank_triples(params: DataFrame, test: DataFrame, known: DataFrame, model: str,
                 block_rows: int = _BLOCK_ROWS, target_rows: int = 512, query_rows: int = _BLOCK_ROWS) -> DataFrame:
    """Filtered realistic ranks as ``s, p, o, side, rank``.

    Each test triple is ranked against all entities in head and in tail position; candidates
    that make a known triple are left out, ties count half. Entities are packed into blocks, a
    binary row each. Test triples with the same query (anchor, relation, side) make lists of at most
    about ``target_rows``, and at most about ``query_rows`` of these a packed batch, which holds each of
    its relations once; where that makes few tasks, batches are smaller. Every batch meets every block in
    a task of its own, and known answers join them block by block; pairs of test triples and entities
    exist only inside numpy. Triples whose entities or relation have no
    vector are not ranked.
    """
    has_extra = model in ("TransH", "TransR")
    ent = params.filter(F.col("kind") == "e").select("id", "label", "vec")
    n_blocks = max(1, math.ceil(ent.count() / block_rows))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(n_blocks)).cast("int")
    rel = params.filter(F.col("kind") == "r").select(F.col("label").alias("p"), F.col("vec").alias("rv"))
    extra = params.filter(F.col("kind") == "x").select(F.col("label").alias("p"), F.col("vec").alias("xv"))
    relations = rel.join(extra, "p") if has_extra else rel.withColumn("xv", F.lit(None).cast("array<double>"))

    def sides(df):
        """Both readings of a triple: the anchor that is given and the answer that is sought."""
        return df.select(*TRIPLE, F.explode(F.array(F.lit("head"), F.lit("tail"))).alias("side")).withColumns({
            "anchor": F.when(F.col("side") == "tail", F.col("s")).otherwise(F.col("o")),
            "answer": F.when(F.col("side") == "tail", F.col("o")).otherwise(F.col("s"))})

    vec = lambda key, out: ent.select(F.col("label").alias(key), F.col("vec").alias(out))
    # One score serves both sides of a triple.
    scored = score_triples(test.select(*TRIPLE).distinct().join(vec("s", "_h"), "s").join(vec("o", "_t"), "o").join(relations, "p"),
                           model, "_h", "rv", "_t", "xv" if has_extra else None, "score").select(*TRIPLE, "score")
    # The number of a target only has to be stable, so the scored targets are materialised.
    targets = cut_lineage(scored.select(
        *TRIPLE, "score", F.explode(F.array(F.lit("head"), F.lit("tail"))).alias("side")).withColumn(
        "anchor", F.when(F.col("side") == "tail", F.col("s")).otherwise(F.col("o")))).withColumn("target", F.monotonically_increasing_id())
    query = ["side", "anchor", "p"]
    sizes = targets.groupBy(*query).agg(F.count(F.lit(1)).alias("_n"))
    lists = cut_lineage(
        targets.join(sizes, query)
        .withColumn("_part", F.pmod(F.xxhash64("target"), F.ceil(F.col("_n") / F.lit(target_rows))))
        .groupBy(*query, "_part")
        .agg(F.collect_list("target").alias("targets"), F.collect_list("score").alias("scores"))).withColumn("q", F.monotonically_increasing_id())
    n_batches = _batch_count(lists.count(), n_blocks, query_rows, test.sparkSession.sparkContext.defaultParallelism)
    batch = F.pmod(F.xxhash64("q"), F.lit(n_batches)).cast("int")
    numbered = lists.withColumn("batch", batch)
    none = lambda kind: F.lit(None).cast(kind)
    asked = numbered.join(vec("anchor", "vec"), "anchor").select(
        "batch", F.lit(1).alias("kind"), "q", "side", "p", "vec", none("array<double>").alias("xv"), "targets", "scores")
    used = numbered.select("batch", "p").distinct().join(relations, "p").select(
        "batch", F.lit(0).alias("kind"), none("long").alias("q"), none("string").alias("side"), "p", F.col("rv").alias("vec"), "xv",
        none("array<long>").alias("targets"), none("array<double>").alias("scores"))
    stacked = used.unionByName(asked).repartitionById(n_batches, "batch").sortWithinPartitions("batch", "kind").mapInArrow(_pack_queries(has_extra), _RANK_ROWS)
    packed = ent.select(block("id").alias("block"), "id", "vec").repartitionById(n_blocks, "block").sortWithinPartitions("block").mapInArrow(_pack_entities, _RANK_ROWS)
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    answers = (sides(known.select(*TRIPLE).distinct())
               .join(ent.select(F.col("label").alias("answer"), F.col("id").alias("aid")), "answer")
               .groupBy(*query, block("aid").alias("block")).agg(F.collect_set("aid").alias("known"))
               .join(numbered.select(*query, "q", "batch"), query)
               .select("block", "batch", F.lit(2).alias("kind"), "q", "known", *[none("binary").alias(f"p{i}") for i in range(9)]))
    met = packed.drop("batch").select(number(n_batches).alias("batch"), "*").unionByName(
        stacked.drop("block").select(number(n_blocks).alias("block"), "*")).unionByName(answers)
    counts = met.repartitionById(n_blocks * n_batches, F.col("block") * n_batches + F.col("batch")).sortWithinPartitions("block", "batch", "kind").mapInArrow(
        _rank_blocks(model, has_extra), "target long, better long, equal long"
    ).groupBy("target").agg(F.sum("better").alias("better"), F.sum("equal").alias("equal"))
    return targets.join(counts, "target").select(
        *TRIPLE, "side", (1 + F.col("better") + F.col("equal") / 2).alias("rank"))


def evaluate_kge(params: DataFrame, test: DataFrame, known: DataFrame, model: str, **limits) -> DataFrame:
    """Mean reciprocal rank and hits at 1, 3, 5 and 10 as ``side, metric, value``.

    ``known`` must hold all true triples, those of ``test`` among them.
    """
    ranks = rank_triples(params, test, known, model, **limits)
    return rank_metrics(ranks)


def rank_metrics(ranks: DataFrame) -> DataFrame:
    """Ranking metrics for head, tail and both sides, in one pass."""
    sides = ranks.select("rank", F.explode(F.array(F.col("side"), F.lit("both"))).alias("side"))
    names = {"inverse_harmonic_mean_rank": F.avg(1 / F.col("rank")),
             **{f"hits_at_{k}": F.avg((F.col("rank") <= k).cast("double")) for k in (1, 3, 5, 10)}}
    wide = sides.groupBy("side").agg(*[c.alias(n) for n, c in names.items()])
    return wide.unpivot(["side"], list(names), "metric", "value")


# --- neighbourhood aggregation --------------------------------------------------------------------

def message_pass(vectors: DataFrame, triples: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """One layer of relational aggregation: ``label, vec``.

    Each entity receives, per relation, the mean of its sources' vectors, transformed by that
    relation's matrix (identity by default), and sums over relations. A mean of vectors sorts its
    rows, so these are first dealt by receiver in parts of a measured size; a hot receiver has several.
    """
    sent = triples.join(vectors.select(F.col("label").alias("s"), "vec").hint("merge"), "s").hint("rebalance", F.col("o"))
    means = sent.groupBy("o", "p").agg(Summarizer.mean(array_to_vector("vec")).alias("mean"))
    rows = means.select("o", "p", vector_to_array("mean").alias("vec"))
    if weights:
        size = sum(np.asarray(w).nbytes for w in weights.values())
        if size > _BROADCAST_BYTES:
            raise ValueError(f"weights of {size} bytes exceed what is shipped to every task ({_BROADCAST_BYTES})")

        @F.pandas_udf("array<double>")
        def apply(p: pd.Series, v: pd.Series) -> pd.Series:
            out, vectors = v.copy(), _stack(v) if len(v) else None
            for name in set(p) & set(weights):
                at = np.flatnonzero(p.to_numpy() == name)
                out.iloc[at] = pd.Series(list(np.einsum("ij,nj->ni", weights[name], vectors[at])), index=out.index[at])
            return out
        rows = rows.withColumn("vec", apply("p", "vec"))
    return rows.groupBy("o").agg(Summarizer.sum(array_to_vector("vec")).alias("sum")).select(
        F.col("o").alias("label"), vector_to_array("sum").alias("vec"))


# --- experiments and features -----------------------------------------------------------------------

def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A completely written table, or None where there is none yet.

    Writers leave ``_SUCCESS`` last; a table without it was interrupted and does not count.
    """
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS").select("path")
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def train_or_load(spark: SparkSession, path: str, train, force: bool = False) -> DataFrame:
    """Stored parameters, unless there are none or ``force``: then those of ``train()``, stored."""
    found = None if force else stored(spark, path)
    if found is not None:
        return found
    train().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def grid_split(triples: DataFrame) -> DataFrame:
    """The split that experiments use: inverse triples are added to the training part alone.

    What is tested or validated is a given triple, and its own reverse is never trained.
    """
    own = F.struct(*TRIPLE, "split")
    reverse = F.struct(F.col("o").alias("s"), F.concat("p", F.lit("_inverse")).alias("p"), F.col("s").alias("o"), "split")
    return split_triples(triples).select(F.inline(F.when(F.col("split") == "train", F.array(own, reverse)).otherwise(F.array(own))))


def train_experiment(spark: SparkSession, split: DataFrame, model: str, dim: int, path: str, force: bool = False, **options) -> DataFrame:
    """The parameters of one experiment on a :func:`grid_split`, stored under its name, or those that are stored.

    Whoever needs an experiment's vectors takes them from here, so they never depend on who asked first.
    """
    def train() -> DataFrame:
        kept = cut_lineage(split)
        of = lambda name: kept.filter(F.col("split") == name).select(*TRIPLE)
        return train_kge(of("train"), of("validation"), model, dim, **options)[0]

    return train_or_load(spark, f"{path}/{model}_dim_{dim}", train, force)


def run_grid(spark: SparkSession, triples: DataFrame, configs: Sequence[tuple[str, int]], path: str,
             force: bool = False, **options) -> tuple[DataFrame | None, dict[str, str]]:
    """Metrics of all experiments and the errors of those that failed.

    A configuration is (model, dimension); a repeated one runs once. See :func:`grid_split`.
    """
    split = cut_lineage(grid_split(triples))
    of = lambda name: split.filter(F.col("split") == name)
    metrics, failed = None, {}
    for model, dim in dict.fromkeys(configs):
        experiment = f"{model}_dim_{dim}"
        try:
            params = train_experiment(spark, split, model, dim, path, force, **options)
            found = evaluate_kge(params, of("test"), split, model).withColumns({
                "experiment": F.lit(experiment), "rank_type": F.lit("realistic"), "dataset": F.lit("testing")})
            found = cut_lineage(found)
            metrics = found if metrics is None else metrics.unionByName(found)
        except Exception as error:  # noqa: BLE001 - one experiment must not stop the others
            failed[experiment] = str(error)
    return metrics, failed


def compare_experiments(metrics: DataFrame) -> DataFrame:
    """Comparison table: one row per experiment, best reciprocal rank first.

    ``metrics``: ``experiment, side, rank_type, dataset, metric, value`` with experiments named
    ``<model>_dim_<n>``. Only test metrics of both sides and realistic ranks count.
    """
    kept = metrics.filter((F.col("side") == "both") & (F.col("rank_type") == "realistic")
                          & (F.col("dataset") == "testing"))
    name = F.split_part("experiment", F.lit("_dim_"), F.lit(1))
    dim = F.split_part("experiment", F.lit("_dim_"), F.lit(2))
    shown = F.concat(name, F.lit(" (d="), dim, F.lit(")"))
    return metrics_wide(kept.withColumn("experiment", shown))


def experiment_long(metrics: DataFrame) -> DataFrame:
    """Long form of the comparison with model, dimension and display names."""
    kept = metrics.filter((F.col("side") == "both") & (F.col("rank_type") == "realistic")
                          & (F.col("dataset") == "testing"))
    return kept.select(
        F.split_part("experiment", F.lit("_dim_"), F.lit(1)).alias("model"),
        F.split_part("experiment", F.lit("_dim_"), F.lit(2)).try_cast("int").alias("dimension"),
        lookup("metric", vocab.METRIC_NAMES, F.col("metric")).alias("metric"), "value")


def embedding_features(vectors: DataFrame, dim: int, kind: str = "municipality",
                       key: str = "municipality_id", label: str = "label", vec: str = "vec") -> DataFrame:
    """Vectors of one entity kind as ``<key>, emb_dim_0 ..``, the key taken from the URI."""
    mark = f"/{kind}/"
    return vectors.filter(F.contains(F.col(label), F.lit(mark))).select(
        F.split_part(label, F.lit(mark), F.lit(-1)).alias(key),
        *[F.get(F.col(vec), F.lit(j)).alias(f"emb_dim_{j}") for j in range(dim)])
