"""Ranked lexical search over bit-sliced Bloom signatures, with exact scores.

An index row is a block of documents with similar numbers of keys. Its signature is a Bloom filter per
document, stored by slices: one bitmap over the block's documents for every bit position. A
document's keys are its terms and, for terms that occur twice, four and eight times or more, the
term at that level. Beside the signature a block holds the exact counts of its documents' terms.

For an item, the bitmaps of a term's positions are intersected, which overestimates the documents
that hold the term so often; the sums of the terms' weights over these bitmaps, level by level, give
each document an upper bound of its score. Documents are rescored exactly by falling bound until the
best ``k`` cannot be reached any more, so no document is left out that could be among them. A task
carries its best results from block to block and sends ``k`` rows an item; a window ranks these.

Items are taken in blocks of bounded size, each block against all documents. Terms are maximal runs
of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case. A null text has no
term, nor an empty one; such documents and items give no rows. Each document row counts as a
document, repeated rows too; equal rows of items are one item. A null document id comes last among
equal scores. Empty tables give an empty result, and further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm.common import keyed, map_arrow, quoted
from terraloom.session import materialise

ITEMS = 1024  # items searched at once, about
PAIRS = 1 << 17  # keys of documents in a block, about
_HASHES, _BITS = 4, 10  # bit positions a key, and slices a key
_LEVELS = 4  # a key for 1, 2, 4 and 8 occurrences
_MAX_SLICES = 1 << 20
_CHUNK = 32  # documents rescored at once
_LAST = np.iinfo(np.int64).max  # stands for a null id
_INDEX = "slices_of binary, slices int, ids array<long>, lengths binary, terms long, documents long, vocabulary binary, held_by binary, starts binary, term binary, tf binary"
_KINDS = {"slices_of": pa.binary(), "slices": pa.int32(), "ids": pa.list_(pa.int64()), "lengths": pa.binary(), "terms": pa.int64(), "documents": pa.int64(),
          "vocabulary": pa.binary(), "held_by": pa.binary(), "starts": pa.binary(), "term": pa.binary(), "tf": pa.binary()}
_find_terms = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def terms_of(text: str) -> list[bytes]:
    """The terms in UTF-8, in which all bytes of a character beyond ASCII are beyond ASCII."""
    return _find_terms(text.encode("utf-8", "surrogatepass").lower())


def positions(hashes: np.ndarray, level: int, slices: int) -> np.ndarray:
    """Bit positions of the keys ``(term, level)``, a row a key."""
    steps = np.arange(1, _HASHES + 1, dtype=np.uint64) + np.uint64(level * _HASHES)
    z = hashes[:, None] + steps * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) % np.uint64(slices)).astype(np.int64)


def hash_terms(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))


class Builder:
    """Documents with keys of one order of magnitude, until they make up a block."""

    def __init__(self, size_class: int, pairs: int):
        self.slices = min(_BITS << size_class, _MAX_SLICES)
        self.room = min(1024, max(1, pairs >> size_class))
        self.clear()

    def clear(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.lengths, self.term, self.tf = [], [], [], []

    def add(self, doc_id, count: Counter) -> tuple | None:
        place = self.vocabulary
        term = np.fromiter((place.setdefault(t, len(place)) for t in count), np.int32, len(count))
        tf = np.fromiter(count.values(), np.int32, len(count))
        order = np.argsort(term)
        self.ids.append(doc_id)
        self.lengths.append(int(tf.sum(dtype=np.int64)))
        self.term.append(term[order])
        self.tf.append(tf[order])
        return self.take() if len(self.ids) >= self.room else None

    def take(self) -> tuple:
        """The block as an index row."""
        vocabulary = list(self.vocabulary)
        starts = np.cumsum([0, *map(len, self.term)]).astype("<i8")
        term, tf = np.concatenate(self.term), np.concatenate(self.tf)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(starts))
        hashes = hash_terms(vocabulary)
        bits = np.zeros((self.slices, -(-len(self.ids) // 8) * 8), np.uint8)
        for level in range(_LEVELS):
            often = np.flatnonzero(tf >= 1 << level)
            bits[positions(hashes[term[often]], level, self.slices), doc[often, None]] = 1
        row = (np.packbits(bits, axis=1).tobytes(), self.slices, self.ids, np.array(self.lengths, "<i8").tobytes(), sum(self.lengths), len(self.ids),
               b" ".join(vocabulary), np.bincount(term, minlength=len(vocabulary)).astype("<i4").tobytes(), starts.tobytes(),
               term.astype("<i4").tobytes(), tf.astype("<i4").tobytes())
        self.clear()
        return row


def build_index(docs: DataFrame, id_column: str = "doc_id", text: str = "text", pairs: int = PAIRS) -> DataFrame:
    """The index of all documents that have a term, a block a row, written to the shared folder."""
    def run(batches):
        builders: dict[int, Builder] = {}
        for batch in batches:
            for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count = Counter(terms_of(t))
                if not count:
                    continue
                keys = sum(min(tf.bit_length(), _LEVELS) for tf in count.values())
                size_class = max(5, (keys - 1).bit_length())
                if size_class not in builders:
                    builders[size_class] = Builder(size_class, pairs)
                if row := builders[size_class].add(doc_id, count):
                    yield row
        for builder in builders.values():
            if builder.ids:
                yield builder.take()

    rows = keyed(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return materialise(map_arrow(rows, run, _INDEX, **_KINDS), "lexical-index")


class Block:
    """An index row, opened for searching."""

    def __init__(self, row: dict, documents: int, terms: int):
        self.ids = np.array([_LAST if i is None else i for i in row["ids"]], np.int64)
        self.slices = row["slices"]
        self.bitmaps = np.frombuffer(row["slices_of"], np.uint8).reshape(self.slices, -1)
        n = np.frombuffer(row["lengths"], "<i8")
        self.norm = 75 + 25 * n * documents // terms
        self.starts, self.term, self.tf = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["term"], "<i4"), np.frombuffer(row["tf"], "<i4")
        self.vocabulary = {t: i for i, t in enumerate(row["vocabulary"].split(b" "))}
        most = np.maximum.reduceat(self.tf, self.starts[:-1]).astype(np.int64)
        # What one unit of weight can add for a term found at a level and not above it, as steps from level to level.
        self.gain, before = [], np.zeros(len(n), np.int64)
        for level in range(_LEVELS):
            highest = most if level == _LEVELS - 1 else np.minimum(most, (2 << level) - 1)
            now = saturation(highest, self.norm)
            self.gain.append(now - before)
            before = now

    def presence(self, hashes: np.ndarray) -> list[np.ndarray]:
        """By level, for every term a bitmap of the documents that may hold it so often."""
        out = []
        for level in range(_LEVELS):
            p = positions(hashes, level, self.slices)
            found = np.bitwise_and.reduce(self.bitmaps[p], axis=1)
            if out:
                found &= out[-1]
            out.append(found)
        return [np.unpackbits(found, axis=1, count=len(self.ids)) for found in out]

    def scores(self, doc: int, local: np.ndarray, weights: np.ndarray) -> int:
        """The exact score; ``local`` are the terms' numbers in this block, those it lacks left out."""
        a, b = self.starts[doc], self.starts[doc + 1]
        held = self.term[a:b]
        at = np.minimum(np.searchsorted(held, local), len(held) - 1)
        hit = held[at] == local
        return int((weights[hit] * saturation(self.tf[a:b][at[hit]].astype(np.int64), self.norm[doc])).sum())


def saturation(tf, norm):
    return 1_000_000_000 * tf // (1000 * tf + 12 * norm)


class Best:
    """An item's best results so far: highest score first, then smallest id."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def last(self) -> tuple[int, int]:
        """What a document must come before: score and id."""
        return (-self.rows[-1][0], self.rows[-1][1]) if len(self.rows) == self.k else (0, -1)

    def add(self, found: list[tuple[int, int]]) -> None:
        self.rows = sorted([*self.rows, *((-s, i) for s, i in found if s > 0)])[:self.k]


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           items_at_once: int = ITEMS, pairs: int = PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``k`` documents with the highest scores above 0."""
    return search_index(build_index(docs, id_column, text, pairs), items, k, item_id, item_text, items_at_once)


def search_index(index: DataFrame, items: DataFrame, k: int = 20, item_id: str = "item_id", item_text: str = "text", items_at_once: int = ITEMS) -> DataFrame:
    """As :func:`search`, on an index that is there already."""
    documents, terms = index.agg(F.sum("documents"), F.sum("terms")).first()
    asked = materialise(items.select(F.col(quoted(item_id)).cast("long").alias("item_id"), F.col(quoted(item_text)).cast("string").alias("text")).distinct(), "items")
    blocks = max(1, -(-asked.count() // items_at_once))
    found = []
    for block in range(blocks if documents else 0):
        some = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        counts = [(r["item_id"], Counter(terms_of(r["text"] or ""))) for r in some]
        one = _search_block(index, [c for c in counts if c[1]], k, documents, terms)
        found.append(materialise(one, "found") if blocks > 1 else one)
    if not found:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def document_frequencies(index: DataFrame, terms: list[bytes]) -> list[int]:
    """The number of documents that hold each term."""
    place = {t: i for i, t in enumerate(terms)}

    def run(batches):
        total = np.zeros(len(place), np.int64)
        for batch in batches:
            for vocabulary, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                df = np.frombuffer(df, "<i4")
                for n, t in enumerate(vocabulary.split(b" ")):
                    if (i := place.get(t)) is not None:
                        total[i] += df[n]
        at = np.flatnonzero(total)
        yield from zip(at.tolist(), total[at].tolist())

    out = [0] * len(terms)
    for i, df in map_arrow(index.select("vocabulary", "held_by"), run, "i int, n long", i=pa.int32(), n=pa.int64()).groupBy("i").agg(F.sum("n")).collect():
        out[i] = df
    return out


def _search_block(index: DataFrame, items: list[tuple], k: int, documents: int, terms: int) -> DataFrame:
    asked = sorted({t for _, count in items for t in count})
    place = {t: i for i, t in enumerate(asked)}
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in document_frequencies(index, asked)], np.int64)
    wanted = []  # for each item: its terms' numbers, and their weights times their occurrences
    for _, count in items:
        of = np.array([place[t] for t in count], np.int64)
        wanted.append((of, weight[of] * np.array(list(count.values()), np.int64)))
    hashes, keys = hash_terms(asked), [i for i, _ in items]

    def run(batches):
        best = [Best(k) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({name: batch.column(n)[i].as_py() for n, name in enumerate(batch.schema.names)}, documents, terms)
                may = block.presence(hashes)
                own = np.array([block.vocabulary.get(t, -1) for t in asked], np.int64)
                for (of, weights), held in zip(wanted, best):
                    bound = np.zeros(len(block.ids), np.int64)
                    for gain, bits in zip(block.gain, may):
                        bound += gain * (weights.astype(float) @ bits[of]).astype(np.int64)  # whole numbers below 2^53
                    score, last = held.last()
                    left = np.flatnonzero((bound > score) | (bound == score) & (block.ids < last) & (bound > 0))
                    if not len(left):
                        continue
                    left = left[np.lexsort((block.ids[left], -bound[left]))]
                    local = own[of]
                    there = local >= 0
                    local, weights = local[there], weights[there]
                    for a in range(0, len(left), _CHUNK):
                        chunk = left[a:a + _CHUNK]
                        score, last = held.last()
                        if bound[chunk[0]] < score:
                            break
                        chunk = chunk[(bound[chunk] > score) | (block.ids[chunk] < last)]
                        held.add([(block.scores(d, local, weights), int(block.ids[d])) for d in chunk.tolist()])
        for n, held in enumerate(best):
            for score, doc in held.rows:
                yield n, keys[n], None if doc == _LAST else doc, -score

    rows = map_arrow(index, run, "item int, item_id long, doc_id long, score long", item=pa.int32(), item_id=pa.int64(), doc_id=pa.int64(), score=pa.int64())
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
