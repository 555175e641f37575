"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Trees are fitted on a bounded sample and every vector is routed down each of them. A query walks
all trees through one shared priority queue, ordered by how far it lies on the wrong side of the
splits passed, until it has met ``probes`` leaves; what lies in these leaves is ranked exactly, in
double precision, on the original vectors. Larger inner products mean nearer, ties go to smaller
ids. For the trees alone, vectors get one more coordinate that makes their norms equal, which turns
largest inner product into smallest angle.

The number of leaves is fixed by the sample, so a query meets a fixed share of them and recall does
not fall as the table grows. A leaf is cut into blocks of bounded size, and each query of the leaf
visits all its blocks. Equal vectors are one node that carries its ``k + 1`` smallest ids, which is
all that any answer can hold of them; queries with equal vectors are searched once.

Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows
with a null id or, where lengths differ, vectors of another than the most frequent length (the
longer at a tie). Repeated rows count once. A query with fewer candidates than ``k`` gets them all.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm.common import map_arrow, quoted
from terraloom.session import materialise

TREES = 4
SAMPLE = 1 << 14  # vectors that the trees are fitted on
LEAF = 128  # sampled vectors in a leaf at most
PROBES = 200  # leaves that a query meets, of at most TREES * SAMPLE / LEAF * 2
BLOCK = 1 << 14  # vectors of a leaf searched at once
_HELD = 1 << 20  # results of a task held for combining
_SCORES = 1 << 22  # scores of a block computed at once


@dataclass(frozen=True)
class Forest:
    normals: np.ndarray  # splits x dimensions
    offsets: np.ndarray
    children: np.ndarray  # splits x 2; a leaf is -1 - its number
    roots: tuple[int, ...]
    leaves: int


def fit_forest(sample: np.ndarray, trees: int, leaf: int, seed: int = 7) -> Forest:
    """Each split projects its vectors on the difference of two of them and cuts at the median."""
    rng = np.random.default_rng(seed)
    normals, offsets, children, roots, leaves = [], [], [], [], 0
    for _ in range(trees):
        todo = [(np.arange(len(sample)), None)]
        while todo:
            rows, place = todo.pop()
            split = None
            if len(rows) > leaf:
                for _ in range(3):
                    a, b = rng.choice(rows, 2, replace=False)
                    normal = sample[a] - sample[b]
                    length = np.linalg.norm(normal)
                    if not length > 0:
                        continue
                    normal = normal / length
                    along = sample[rows] @ normal
                    offset = float(np.median(along))
                    right = along > offset
                    if right.any() and not right.all():
                        split = normal, offset, right
                        break
            if split is None:
                me, leaves = -1 - leaves, leaves + 1
            else:
                me = len(normals)
                normals.append(split[0])
                offsets.append(split[1])
                children.append([0, 0])
                todo += [(rows[~split[2]], (me, 0)), (rows[split[2]], (me, 1))]
            if place:
                children[place[0]][place[1]] = me
            else:
                roots.append(me)
    dim = sample.shape[1]
    return Forest(np.array(normals, np.float32).reshape(-1, dim), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), tuple(roots), leaves)


def route(vectors: np.ndarray, forest: Forest) -> np.ndarray:
    """The leaf of every vector in every tree."""
    out = np.empty((len(vectors), len(forest.roots)), np.int64)
    for t, root in enumerate(forest.roots):
        at = np.full(len(vectors), root)
        while (inner := np.flatnonzero(at >= 0)).size:
            n = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], forest.normals[n]) > forest.offsets[n]
            at[inner] = forest.children[n, side.astype(np.int64)]
        out[:, t] = -1 - at
    return out


def nearest_leaves(query: np.ndarray, forest: Forest, probes: int) -> list[int]:
    """The first ``probes`` leaves that the shared queue yields."""
    margins = (forest.normals @ query - forest.offsets).tolist() if len(forest.normals) else []
    children = forest.children.tolist()
    queue = [(0.0, r) for r in forest.roots]
    heapq.heapify(queue)
    found: list[int] = []
    while queue and len(found) < probes:
        wrong, n = heapq.heappop(queue)
        if n < 0:
            found.append(-1 - n)
            continue
        m, (left, right) = margins[n], children[n]
        heapq.heappush(queue, (max(wrong, m), left))
        heapq.heappush(queue, (max(wrong, -m), right))
    return found


def usable(vector: str) -> Column:
    v = F.col(quoted(vector))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding", trees: int = TREES,
           sample: int = SAMPLE, leaf: int = LEAF, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row with ``is_query``, its ``k`` nearest found.

    ``is_query`` is an expression over the columns of ``vectors``.
    """
    rows = vectors.where(usable(vector) & F.col(quoted(id_column)).isNotNull()).select(
        F.col(quoted(id_column)).cast("long").alias("id"), F.col(quoted(vector)).cast("array<double>").alias("v"), is_query.alias("asks"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dim = lengths["n"] if lengths else 1
    rows = rows.where(F.size("v") == dim)
    # Window limits act before the shuffle, so a vector shared by very many rows sends few of them.
    place = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v").withColumn("n", F.dense_rank().over(place)).where(F.col("n") <= k + 1)
    nodes = materialise(few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")).withColumn("node", F.get("ids", F.lit(0)))
                        .select(F.xxhash64("node", "v").alias("node"), "v", "ids"), "nodes")
    asking = materialise(rows.where("asks").groupBy("v").agg(F.min("id").alias("n")).select(F.xxhash64("v", "n").alias("query"), "v"), "asking")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    longest = nodes.select(F.max(norm)).first()[0] or 1.0
    picked = nodes.orderBy(F.xxhash64("node"), "node").select("v").limit(sample).collect()
    forest = fit_forest(_lifted(np.array([r[0] for r in picked]).reshape(-1, dim), longest), trees, leaf)

    def to_leaves(batches):
        for batch in batches:
            ids, firsts, v = batch.column(0).to_pylist(), batch.column(2).to_pylist(), _matrix(batch.column(1), dim)
            for i, first, x, leaves in zip(ids, firsts, v, route(_lifted(v, longest), forest)):
                for n in leaves.tolist():
                    yield n, i, first, x.tobytes()

    def to_probes(batches):
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), dim)):
                unit = np.append(x / np.linalg.norm(x), 0.0) * longest
                for n in nearest_leaves(unit, forest, probes):
                    yield n, i, 0, x.tobytes()

    kinds = {"leaf": pa.int64(), "who": pa.int64(), "first": pa.int64(), "x": pa.binary()}
    schema = "leaf long, who long, first long, x binary"
    posted = materialise(map_arrow(nodes.select("node", "v", F.get("ids", F.lit(0))), to_leaves, schema, **kinds), "posted")
    probing = map_arrow(asking, to_probes, schema, **kinds)
    # One row a leaf, as many as the sample allows.
    blocks = materialise(posted.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "blocks")
    members = posted.join(F.broadcast(blocks), "leaf").select("leaf", F.pmod(F.xxhash64("who"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("asks"), "who", "first", "x")
    visits = probing.join(F.broadcast(blocks), "leaf").select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("asks"), "who", "first", "x")
    dealt = members.unionByName(visits).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asks")

    def rank(batches):
        combined = _Best(k + 1)
        key, members, matrix = None, [], None
        for batch in batches:
            leaf_no, block_no, asks, who, first = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            x = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.float64).reshape(-1, dim)
            change = np.flatnonzero((leaf_no[1:] != leaf_no[:-1]) | (block_no[1:] != block_no[:-1]) | (asks[1:] != asks[:-1])) + 1
            bounds = [0, *change.tolist(), len(who)]
            for a, b in zip(bounds, bounds[1:]):
                now = (leaf_no[a], block_no[a])
                if now != key:
                    key, members, matrix = now, [], None
                if not asks[a]:
                    members.append((who[a:b], first[a:b], x[a:b]))
                    continue
                if not members:
                    continue
                if matrix is None:
                    matrix = [np.concatenate(part) for part in zip(*members)]
                yield from combined.add(who[a:b], x[a:b], *matrix)
        yield from combined.take()

    found = map_arrow(dealt, rank, "query long, node long, first long, score double", query=pa.int64(), node=pa.int64(), first=pa.int64(), score=pa.float64()) \
        .groupBy("query", "node", "first").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    best = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).join(nodes.select("node", "ids"), "node")
    # For each distinct query vector its k + 1 nearest ids, itself among them; then each row leaves itself out.
    listed = best.groupBy("query").agg(F.flatten(F.collect_list(
        F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("id"))))).alias("near"))
    answers = materialise(listed.join(asking, "query").select("v", F.slice(F.array_sort("near"), 1, k + 1).alias("near")), "answers")
    own = rows.where("asks").select("id", "v").distinct().join(answers, "v")
    others = own.select(F.col("id").alias("query_id"), F.slice(F.filter("near", lambda s: s["id"] != F.col("id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("n", "s")).select(
        "query_id", (F.col("n") + 1).alias("rank"), F.col("s.id").alias("vec_id"), (-F.col("s.far")).alias("score"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """One more coordinate, so that all norms are ``longest``."""
    return np.concatenate([v, np.sqrt(np.maximum(0.0, longest ** 2 - (v * v).sum(1)))[:, None]], axis=1)


class _Best:
    """The best results of each query that a task has met, combined before they are sent."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0

    def add(self, who: np.ndarray, x: np.ndarray, ids: np.ndarray, firsts: np.ndarray, matrix: np.ndarray):
        step = max(1, _SCORES // len(ids))
        for at in range(0, len(who), step):
            asked, q = who[at:at + step], x[at:at + step]
            scores = q @ matrix.T
            if len(ids) > self.k:
                least = np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
                row, col = np.nonzero(scores >= (least - 1e-9 * np.maximum(1.0, np.abs(least)))[:, None])  # all that may tie with the last
            else:
                row, col = (part.ravel() for part in np.indices(scores.shape))
            self.held.append((asked[row], ids[col], firsts[col], (matrix[col] * q[row]).sum(1)))
            self.size += len(row)
            if self.size > _HELD:
                self.combine()
                if self.size > _HELD // 2:
                    yield from self.take()

    def combine(self) -> None:
        who, node, first, score = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((node, first, -score, who))
        who, node, first, score = who[order], node[order], first[order], score[order]
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (node[1:] != node[:-1])  # a node met in two trees
        who, node, first, score = who[new], node[new], first[new], score[new]
        keep = np.arange(len(who)) - np.searchsorted(who, who, "left") < self.k
        self.held = [(who[keep], node[keep], first[keep], score[keep])]
        self.size = int(keep.sum())

    def take(self):
        if self.held:
            self.combine()
            yield from zip(*(c.tolist() for c in self.held[0]))
        self.held, self.size = [], 0
