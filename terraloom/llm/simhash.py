"""Near-duplicate documents by SimHash and an inverted index over the bytes of the fingerprints.

A fingerprint has eight bytes. Two that differ in at most three bits share at least five bytes in
place, hence at least four of any seven places. The index therefore posts each distinct
fingerprint under every choice of four of the first seven places with their bytes. Within a posting
list pairs are tallied by the bytes they share in place; those that reach five are verified bit by
bit. A list is searched from its smallest member outwards among the members not yet reached, so
that it yields links that connect just what its pairs connect, and a dense list costs little more
than its length. Lists over ``list_rows`` are cut into blocks, and each pair of blocks is a list.

Null texts are empty, and texts without a word have fingerprint zero and are linked like any other.
Equal fingerprints are one node. Rows with a null id keep it and never lend it to a component
unless the component has no other id. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import keyed, map_arrow, packed_rows, quoted, text_of, unpacked_rows
from terraloom.llm.components import connected_components
from terraloom.session import materialise

BITS = 3  # largest difference that links
SHARED = 8 - BITS  # bytes two linked fingerprints share at least
PLACES = list(combinations(range(7), 4))  # 7 = 8 - SHARED + 4
_SHINGLES = 1 << 18  # shingles hashed at once


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles' XXH64 as an unsigned 64-bit integer; zero without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SHINGLES):
        some = words[at:at + _SHINGLES + shingle - 1] if len(words) >= shingle else words
        parts = map(b" ".join, zip(*[some[k:] for k in range(shingle)])) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, fp)``; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fp = fingerprint(t)
                yield i, fp - (1 << 64) if fp >> 63 else fp

    rows = keyed(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, run, "doc_id long, fp long", doc_id=pa.int64(), fp=pa.int64())


def spanning_links(values: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that connect what the pairs of distinct ``values`` within ``bits`` connect."""
    left, links = np.sort(values), []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            u = frontier.pop()
            x = left ^ u
            near = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1) >= 8 - bits  # the tally of shared bytes
            near[near] = np.bitwise_count(x[near].view(np.uint64)) <= bits
            if near.any():
                found = left[near]
                links += [(int(u), int(v)) for v in found]
                frontier += list(found)
                left = left[~near]
    return links


def near_links(prints: DataFrame, bits: int = BITS, list_rows: int = 1 << 20) -> DataFrame:
    """Distinct links ``(a, b)`` among distinct fingerprints ``fp``, enough to connect all that differ in at most ``bits``."""
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(7)]
    keys = [F.lit(n).cast("long") * (1 << 32) + sum((byte[p] * (1 << 8 * k) for k, p in enumerate(places)), F.lit(0).cast("long"))
            for n, places in enumerate(PLACES)]
    posted = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = materialise(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > list_rows)
                        .select("key", F.ceil(F.col("n") / list_rows).cast("int").alias("blocks")), "large")
    # A row of block i goes to every list (i, j) and (j, i): to one list unless its own is large.
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    lists = (posted.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp"))
    dealt = lists.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    def search(batches):
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now)]
            key, low, high, fp = now
            change = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            bounds = np.concatenate([[0], change])
            yield from _runs(bounds, fp, bits)
            held = [c[bounds[-1]:] for c in now]  # the last list may go on
        if held is not None:
            yield from _runs(np.array([0, len(held[3])]), held[3], bits)

    found = map_arrow(dealt, search, "a long, b long", a=pa.int64(), b=pa.int64())
    return found.distinct()


def _runs(bounds: np.ndarray, fp: np.ndarray, bits: int):
    """Links of the lists between consecutive bounds; lists of two are verified all at once."""
    size = np.diff(bounds)
    two = bounds[:-1][size == 2]
    x = fp[two] ^ fp[two + 1]
    near = two[((x.view(np.uint8).reshape(-1, 8) == 0).sum(1) >= 8 - bits) & (np.bitwise_count(x.view(np.uint64)) <= bits)]
    for i in near:
        yield int(fp[i]), int(fp[i + 1])
    for at, n in zip(bounds[:-1][size > 2], size[size > 2]):
        yield from spanning_links(fp[at:at + n], bits)


def fingerprint_components(prints: DataFrame, bits: int = BITS, list_rows: int = 1 << 20) -> DataFrame:
    """Rows ``(fp, component_id)`` for a table ``(doc_id, fp)``: the smallest id of each connected class."""
    first = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
    roots = materialise(connected_components(near_links(first.select("fp"), bits, list_rows)), "roots")
    rooted = materialise(first.join(roots, first.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", bits: int = BITS, list_rows: int = 1 << 20) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    prints = materialise(fingerprints(docs, id_column, text), "prints")
    classes = materialise(fingerprint_components(prints, bits, list_rows), "classes")
    return prints.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """One document of each class, with all its columns: that with the smallest id, then text hash.

    Repeated rows, alike in id and text, are one document.
    """
    mark = F.xxhash64(text_of(text))
    named = docs.select(F.col(quoted(id_column)).cast("long").alias("doc_id"), text_of(text).alias("text"))

    def run(batches):
        for batch in batches:
            for i, t, m in zip(*(batch.column(k).to_pylist() for k in range(3))):
                fp = fingerprint(t)
                yield i, m, fp - (1 << 64) if fp >> 63 else fp

    prints = materialise(map_arrow(named.withColumn("mark", F.xxhash64("text")), run, "doc_id long, mark long, fp long",
                                   doc_id=pa.int64(), mark=pa.int64(), fp=pa.int64()), "prints")
    classes = materialise(fingerprint_components(prints, bits), "classes")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "mark")).alias("top")
    heads = prints.groupBy("fp").agg(least).join(classes, "fp").groupBy("component_id").agg(F.min("top").alias("top")).select("top.doc_id", "top.mark")
    times = prints.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("times"))
    kept = materialise(heads.join(times, heads.doc_id.eqNullSafe(times.doc_id) & (heads.mark == times.mark)).select(heads.doc_id, heads.mark, "times"), "kept")
    rows = packed_rows(docs, key=F.col(quoted(id_column)).cast("long"), text_mark=mark)
    staying = rows.join(kept, rows.key.eqNullSafe(kept.doc_id) & (rows.text_mark == kept.mark))
    once = staying.where("times = 1").select("row")
    again = staying.where("times > 1").groupBy("key", "text_mark").agg(F.first("row").alias("row")).select("row")
    return unpacked_rows(once.unionByName(again), docs.columns)
