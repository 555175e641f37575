"""Token-id files: documents' ids in id order, compressed shard by shard with a Re-Pair grammar.

Format: a Parquet table of shards, each about ``SHARD`` ids of whole documents. Columns:

- ``part``, ``shard``: range partition and number in it; by both, shards are in ascending id order.
- ``first``, ``last``: smallest and largest document id, by which reads of few documents prune files.
- ``before``: ids of the shard's partition that precede the shard; ``ids``: ids in the shard.
- ``doc_ids``, ``known``: int64 ids and a byte that is 0 where the id is null.
- ``doc_tokens``, ``doc_symbols``: uint64 numbers of ids and of symbols of each document.
- ``terminals``: ids are below it; symbol ``terminals + k`` is rule ``k``.
- ``rules``: two uint32 symbols a rule, earlier symbols only; ``lengths``: uint64 expanded lengths.
- ``symbols``: the symbols of all documents, ``width`` bytes each. All numbers are little-endian.

Rules are found in rounds. A round counts the pairs inside documents and takes frequent pairs, most
frequent first, so that no symbol is on the left of one pair and on the right of another; their
occurrences then cannot overlap and are replaced at once. No symbol spans two documents, so any
document is read by its own symbols, and any stretch of it through the expanded lengths.

A null text is an empty document: its end id alone. Null ids come first; documents with equal ids
follow each other in the order of a hash of their text. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm.common import keyed, map_arrow
from terraloom.llm.tokens import word_ids, word_vocabulary

SHARD = 1 << 20
ROUNDS = 5
LEAST = 24  # occurrences that make a pair a rule
_HASH_BITS = 17  # tables that stay in a core's cache
_MIX = 0x9E3779B97F4A7C15


@dataclass
class Grammar:
    terminals: int
    rules: np.ndarray  # n x 2
    lengths: np.ndarray  # n
    symbols: np.ndarray
    ends: np.ndarray  # symbols that end a document


def compress(ids: np.ndarray, ends: np.ndarray, terminals: int, rounds: int = ROUNDS, least: int = LEAST) -> Grammar:
    """A grammar for ``ids``; ``ends`` marks the last id of each document. Ids are below ``terminals``."""
    s, ends = ids.astype(np.uint32), ends.copy()
    rules: list[tuple[int, int]] = []
    most = (1 << 16) - terminals if terminals < 1 << 16 else (1 << 31) - terminals
    for k in range(rounds):
        if len(s) < 2 or len(rules) >= most:
            break
        # A bucket stands for the pair at one of its places, nearly always its most frequent one; pairs
        # that share its bucket are left for the next round, whose hash is another.
        pair = s[:-1].astype(np.uint64)
        pair <<= np.uint64(32)
        pair |= s[1:]
        bucket = ((pair * np.uint64(_MIX + 2 * k)) >> np.uint64(64 - _HASH_BITS)).view(np.int64)
        inside = (np.bincount(bucket, minlength=1 << _HASH_BITS) >= least)[bucket]
        inside &= ~ends[:-1]
        at = np.flatnonzero(inside)
        bucket, pair = bucket[at], pair[at]
        place = np.zeros(1 << _HASH_BITS, np.int64)
        place[bucket] = np.arange(len(at))
        same = pair[place[bucket]] == pair
        place[bucket] = at[place[bucket]]
        at, bucket = at[same], bucket[same]
        n = np.bincount(bucket, minlength=1 << _HASH_BITS)
        some = np.flatnonzero(n >= least)
        chosen = _disjoint(s[place[some]], s[place[some] + 1], n[some], most - len(rules))
        if not chosen:
            break
        name = np.zeros(1 << _HASH_BITS, np.uint32)
        name[some[chosen]] = np.arange(len(chosen), dtype=np.uint32) + np.uint32(terminals + len(rules))
        rules += zip(s[place[some[chosen]]].tolist(), s[place[some[chosen]] + 1].tolist())
        put = name[bucket]
        hit, put = at[put > 0], put[put > 0]
        s[hit] = put
        ends[hit] = ends[hit + 1]
        keep = np.ones(len(s), bool)
        keep[hit + 1] = False
        s, ends = s[keep], ends[keep]
    made = np.array(rules, np.uint32).reshape(-1, 2)
    return Grammar(terminals, made, expanded_lengths(made, terminals), s, ends)


def _disjoint(left: np.ndarray, right: np.ndarray, n: np.ndarray, most: int) -> list[int]:
    """Numbers of pairs, most frequent first, no symbol of which is both a left and a right one."""
    order = np.argsort(-n, kind="stable")
    lefts, rights, chosen = set(), set(), []
    for k, a, b in zip(order.tolist(), left[order].tolist(), right[order].tolist()):
        if a != b and a not in rights and b not in lefts:
            lefts.add(a)
            rights.add(b)
            chosen.append(k)
            if len(chosen) == most:
                break
    return chosen


def expanded_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((1 if a < terminals else out[a - terminals]) + (1 if b < terminals else out[b - terminals]))
    return np.array(out, np.uint64)


def expansions(rules: np.ndarray, terminals: list[bytes]) -> list[bytes]:
    """The ids of every symbol as bytes, terminals first."""
    table = list(terminals)
    for a, b in rules.tolist():
        table.append(table[a] + table[b])
    return table


def terminal_bytes(terminals: int) -> list[bytes]:
    raw = np.arange(terminals, dtype="<u4").tobytes()
    return [raw[i:i + 4] for i in range(0, len(raw), 4)]


def decode(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, plain: list[bytes]) -> np.ndarray:
    """The ids of a run of symbols, looked up in one table of all expansions."""
    n = len(plain)
    table = np.concatenate([np.arange(n, dtype="<u4"), np.frombuffer(b"".join(expansions(rules, plain)[n:]), "<u4")])
    size = np.concatenate([np.ones(n, np.int64), lengths.astype(np.int64)])
    begin = np.cumsum(size) - size
    each = size[symbols]
    upto = np.cumsum(each)
    return table[np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin[symbols] - upto + each, each)]


def decode_slice(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, terminals: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a document from its symbols, expanding only the symbols that reach in."""
    symbols = symbols.astype(np.int64)
    size = np.ones(len(symbols), np.int64)
    size[symbols >= terminals] = lengths[symbols[symbols >= terminals] - terminals]
    upto = np.cumsum(size)
    first, last = np.searchsorted(upto, start, "right"), np.searchsorted(upto, stop, "left")
    out, stack = [], symbols[first:last + 1].tolist()[::-1]
    while stack:
        x = stack.pop()
        if x < terminals:
            out.append(x)
        else:
            a, b = rules[x - terminals].tolist()
            stack += [b, a]
    skip = start - (int(upto[first - 1]) if first else 0)
    return np.array(out[skip:skip + max(0, stop - start)], np.uint32)


_SCHEMA = ("part int, shard int, first long, last long, before long, ids long, doc_ids binary, known binary, doc_tokens binary, "
           "doc_symbols binary, terminals int, rules binary, lengths binary, symbols binary, width int")


def write_token_files(docs: DataFrame, out: str, path: str | None = None, id_column: str = "doc_id", text: str = "text",
                      end_id: int = 2, shard_ids: int = SHARD, rounds: int = ROUNDS) -> None:
    """Encode whole texts, append ``end_id`` to each and write the files under ``out``.

    One shuffle puts the documents into id order; encoding and compression work shard by shard.
    """
    path = path or word_vocabulary()
    end = np.array([end_id], "<u4").tobytes()
    rows = keyed(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("mark", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark").select("doc_id", "text")

    def run(batches):
        words = word_ids(path)
        size = words.tokenizer.get_vocab_size()
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        ids, parts, held = [], [], 0

        def finished():
            n = np.array([len(p) // 4 for p in parts], "<u8")
            stream = np.frombuffer(b"".join(parts), "<u4")
            last = np.zeros(len(stream), bool)
            last[np.cumsum(n).astype(np.int64) - 1] = True
            g = compress(stream, last, size, rounds)
            width = 2 if size + len(g.rules) <= 1 << 16 else 4
            symbols = np.diff(np.flatnonzero(g.ends), prepend=-1).astype("<u8")
            real = [i for i in ids if i is not None]
            return (part, shard, min(real, default=None), max(real, default=None), before, len(stream),
                    np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is not None for i in ids], np.uint8).tobytes(),
                    n.tobytes(), symbols.tobytes(), size, g.rules.astype("<u4").tobytes(), g.lengths.astype("<u8").tobytes(),
                    g.symbols.astype(f"<u{width}").tobytes(), width)

        for batch in batches:
            for i, encoded in zip(batch.column(0).to_pylist(), map(words.encode, batch.column(1).to_pylist())):
                ids.append(i)
                parts.append(encoded + end)
                held += len(encoded) // 4 + 1
                if held >= shard_ids:
                    yield finished()
                    shard, before = shard + 1, before + held
                    ids, parts, held = [], [], 0
        if ids:
            yield finished()

    b, n = pa.binary(), pa.int64()
    map_arrow(ordered, run, _SCHEMA, part=pa.int32(), shard=pa.int32(), first=n, last=n, before=n, ids=n, doc_ids=b, known=b, doc_tokens=b,
              doc_symbols=b, terminals=pa.int32(), rules=b, lengths=b, symbols=b, width=pa.int32()) \
        .write.option("compression", "zstd").parquet(out)


def read_token_files(spark: SparkSession, path: str, wanted: tuple[int, int] | None = None) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids``; ``wanted`` is a range of ids to read.

    ``start`` counts the ids of all documents before. Sums over partitions, one row each, are all
    that is gathered for it.
    """
    files = spark.read.schema(_SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("ids").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    if wanted:
        files = files.where((F.col("last") >= wanted[0]) & (F.col("first") <= wanted[1]))
    shards = files.join(F.broadcast(base), "part").select(
        (F.col("base") + F.col("before")).alias("start"), "doc_ids", "known", "doc_tokens", "terminals", "rules", "lengths", "symbols", "width")

    def run(batches):
        plain, size = [], -1
        for batch in batches:
            for row in batch.to_pylist():
                if row["terminals"] != size:
                    size = row["terminals"]
                    plain = terminal_bytes(size)
                rules, lengths = np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["lengths"], "<u8")
                raw = decode(np.frombuffer(row["symbols"], f"<u{row['width']}"), rules, lengths, plain).tobytes()
                start, at = row["start"], 0
                for i, k, n in zip(np.frombuffer(row["doc_ids"], "<i8").tolist(), np.frombuffer(row["known"], np.uint8).tolist(),
                                   np.frombuffer(row["doc_tokens"], "<u8").tolist()):
                    if not wanted or k and wanted[0] <= i <= wanted[1]:
                        yield i if k else None, start + at, n, raw[4 * at:4 * (at + n)]
                    at += n

    return map_arrow(shards, run, "doc_id long, start long, n_tokens long, ids binary",
                     doc_id=pa.int64(), start=pa.int64(), n_tokens=pa.int64(), ids=pa.binary())
