"""Byte-level BPE by ranks: two tiers of lookup, and decoding.

A text is cut into pre-tokens by a pattern. Tier one: a minimal perfect hash over the vocabulary's
tokens tells whether the whole pre-token is a token; one displacement per bucket sends every token
to its own slot, and comparing the slot's token settles membership. Tier two: other pre-tokens are
merged from linked bytes, the lowest rank first and the leftmost among equals, off a heap. A worker
resolves each distinct short pre-token once and keeps a bounded number of them between its tasks.

A null text is empty and has no ids. Whole texts are encoded. Rows with null or repeated ids are
carried along, an empty table gives an empty result, further columns are ignored.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import kept_in_worker, keyed, map_arrow

_BUCKET = 4  # tokens a bucket, on average
_CACHED = 48  # longest pre-token, in characters, whose ids are kept
_KEPT = 1_000_000  # pre-tokens kept at once


@dataclass(frozen=True)
class PerfectHash:
    """``slots`` tokens with their ranks; ``shift`` has a bucket's seed, or a slot as ``-1 - slot``."""

    shift: list[int]
    slots: list[bytes]
    ranks: list[int]

    def get(self, token: bytes) -> int | None:
        d = self.shift[xxhash.xxh64_intdigest(token, 0) % len(self.shift)]
        slot = -1 - d if d < 0 else xxhash.xxh64_intdigest(token, d) % len(self.slots)
        return self.ranks[slot] if self.slots[slot] == token else None


def perfect_hash(ranks: dict[bytes, int]) -> PerfectHash:
    """Largest buckets first, each takes the first seed that puts its tokens into free slots; single ones take what is left."""
    n = len(ranks)
    buckets: list[list[bytes]] = [[] for _ in range(max(1, n // _BUCKET))]
    for token in ranks:
        buckets[xxhash.xxh64_intdigest(token, 0) % len(buckets)].append(token)
    shift, slots = [0] * len(buckets), [None] * n
    order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
    free = None
    for b in order:
        tokens = buckets[b]
        if len(tokens) > 1:
            seed = 1
            while True:
                at = [xxhash.xxh64_intdigest(t, seed) % n for t in tokens]
                if len(set(at)) == len(at) and all(slots[s] is None for s in at):
                    break
                seed += 1
            shift[b] = seed
        elif tokens:
            free = free if free is not None else iter([i for i, t in enumerate(slots) if t is None])
            at = [next(free)]
            shift[b] = -1 - at[0]
        else:
            continue
        for s, t in zip(at, tokens):
            slots[s] = t
    return PerfectHash(shift, slots, [ranks[t] for t in slots])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging its bytes. Parts are linked by start: where each ends, and the part before."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = rank.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = end[i]
        if j < 0 or j >= n or end[j] != stop:
            continue  # a part of it has been merged since
        end[i], end[j] = stop, -1
        if stop < n:
            before[stop] = i
            further = end[stop]
            if (r := get(word[i:further])) is not None:
                heappush(heap, (r, i, further))
        p = before[i]
        if p >= 0 and (r := get(word[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    ids, i = [], 0
    while i < n:
        ids.append(rank[word[i:end[i]]])
        i = end[i]
    return ids


class _Known(dict):
    """Ids of the pre-tokens met so far, as bytes; a new one goes through both tiers."""

    def __init__(self, table: PerfectHash, rank: dict[bytes, int]):
        self.table, self.rank = table, rank

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        whole = self.table.get(raw)
        out = np.array([whole] if whole is not None else merge(raw, self.rank), "<u4").tobytes()
        if len(word) <= _CACHED:
            self[word] = out
        return out


class ByteBpe:
    def __init__(self, table: PerfectHash, pattern: str):
        self.find = regex.compile(pattern).findall
        self.rank = dict(zip(table.slots, table.ranks))
        self.known = _Known(table, self.rank)
        self.tokens: list[bytes] = [b""] * (max(table.ranks, default=-1) + 1)
        for t, r in self.rank.items():
            self.tokens[r] = t

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > _KEPT:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, self.find(text or "")))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids, decoded``, ids packed as unsigned 32-bit integers.

    The table is built once, on the driver; its size is the vocabulary's.
    """
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    table = perfect_hash(read_ranks(path))
    pattern = pattern or public_tokenizers.PATTERN

    def run(batches):
        bpe = kept_in_worker(("byte-bpe", path, pattern), lambda: ByteBpe(table, pattern))
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = bpe.encode(t)
                yield i, len(ids) // 4, ids, bpe.decode(ids)

    rows = keyed(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, run, "doc_id long, n_tokens long, ids binary, decoded binary",
                     doc_id=pa.int64(), n_tokens=pa.int64(), ids=pa.binary(), decoded=pa.binary())
