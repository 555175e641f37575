"""Packing of documents into sequences by vector best fit, under three capacities at once.

A sequence holds so many tokens, so many documents and so much attention cost (the sum of squared
piece lengths). Pieces are placed longest first. Each goes to an open sequence that has room in all
three: the one whose residual vector, after placing, has the least weighted norm, or the one whose
residual has the greatest weighted dot product with the piece. Where none has room it opens one. A
piece that alone exceeds the attention capacity has a sequence to itself.

Only documents longer than the window are cut, into pieces of the whole window, of which the first
may be shorter. Each task packs what it reads, a bounded buffer at a time. Sequences that come out
nearly full are final; the pieces of the others join the next buffer, and those left over at a
task's end are dealt to a few tasks and packed once more, so few sequences stay half empty.

A null text is an empty document, which consists of the end id alone. Null and repeated ids are
carried along. An empty table gives an empty result. Columns besides id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import keyed, map_arrow
from terraloom.llm.bytelevel import byte_level_ids
from terraloom.session import materialise

BUFFER = 8192  # pieces packed at once
BUFFER_BYTES = 32 << 20  # and bytes of their ids
_TASK_BITS = 40  # sequence numbers of a task
_SECOND = 1 << 62  # marks the numbers of the second pass
_SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long, final boolean"
_KINDS = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(),
          "sequence_id": pa.int64(), "offset": pa.int64(), "final": pa.bool_()}


def vector_best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm") -> np.ndarray:
    """The sequence, from 0, of each length; ``capacity`` is of tokens, documents and attention cost.

    Lengths are placed longest first, equal ones in their order; of equally good sequences the oldest is taken.
    """
    tokens, documents, attention = capacity
    if rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    if len(lengths) and (lengths.max() > tokens or documents < 1):
        raise ValueError("a piece does not fit an empty sequence")
    scale = np.array([tokens, documents, attention], float)
    factor = np.array(weights) / scale ** 2
    out = np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if len(lengths) else 0
    room, number, used, made = np.empty((3, 1024)), np.empty(1024, np.int64), 0, 0  # residuals of the open sequences, and their numbers
    for at, i in enumerate(order.tolist()):
        size = int(lengths[i])
        piece = np.array([size, 1, size * size], float)
        if at % 256 == 0:  # leave out sequences that nothing fits any more
            stay = (room[:, :used] >= [[least], [1], [least * least]]).all(0)
            used_now = int(stay.sum())
            room[:, :used_now], number[:used_now], used = room[:, :used][:, stay], number[:used][stay], used_now
        fits = np.flatnonzero((room[0, :used] >= size) & (room[1, :used] >= 1) & (room[2, :used] >= size * size))
        if len(fits):
            left = room[:, fits]
            if rule == "norm":
                left = left - piece[:, None]
                best = fits[np.argmin(factor @ (left * left))]
            else:
                best = fits[np.argmax((factor * piece) @ left)]
            room[:, best] -= piece
            out[i] = number[best]
            continue
        if used == room.shape[1]:
            room, number = np.concatenate([room, np.empty_like(room)], axis=1), np.concatenate([number, np.empty_like(number)])
        room[:, used] = np.maximum(np.array([tokens, documents, attention]) - piece, 0)
        number[used] = out[i] = made
        used, made = used + 1, made + 1
    return out


def cut_document(doc_id, ids: bytes, window: int) -> list[tuple]:
    """Pieces ``(doc_id, piece, start, ids)`` of at most ``window`` ids; only the first may be shorter, if it is cut at all."""
    total = len(ids) // 4
    first = total % window or window
    bounds = [0, *range(first, total + 1, window)] if total > window else [0, total]
    return [(doc_id, n, a, ids[4 * a:4 * b]) for n, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def pack_best_fit(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text: str = "text", window: int = 1024, end_id: int = 2,
                  max_documents: int | None = None, max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
                  rule: str = "norm", slack: int | None = None, buffer: int = BUFFER) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids, sequence_id, offset``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers; ordered by ``offset``
    the pieces of a sequence follow each other without a gap. Without ``max_documents`` and
    ``max_attention`` these two bind no earlier than the window does. In the first pass, a sequence
    with at most ``slack`` tokens to spare (a 64th of the window), or with no room for another
    document, is final.
    """
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    end = np.array([end_id], "<u4").tobytes()
    capacity = (window, max_documents or window, max_attention or window ** 2)
    spare = window // 64 if slack is None else slack
    bytes_bound = BUFFER_BYTES

    def fit(pieces: list[tuple]) -> list[list[tuple]]:
        numbers = vector_best_fit(np.array([len(p[3]) // 4 for p in pieces], np.int64), capacity, weights, rule)
        sequences: list[list[tuple]] = [[] for _ in range(int(numbers.max()) + 1 if len(numbers) else 0)]
        for piece, n in zip(pieces, numbers.tolist()):
            sequences[n].append(piece)
        return sequences

    def tight(sequence: list[tuple]) -> bool:
        sizes = [len(p[3]) // 4 for p in sequence]
        return sum(sizes) >= window - spare or len(sizes) >= capacity[1] or sum(s * s for s in sizes) >= capacity[2]

    class Numbered:
        def __init__(self, mark: int):
            self.number = mark + (TaskContext.get().partitionId() << _TASK_BITS) - 1

        def rows(self, sequence: list[tuple], final: bool = True):
            self.number += 1
            offset = 0
            for doc, n, start, ids in sequence:
                yield doc, n, start, len(ids) // 4, ids, self.number, offset, final
                offset += len(ids) // 4

    def first_pass(batches):
        encoder, numbered, held, size = byte_level_ids(path), Numbered(0), [], 0
        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for piece in cut_document(doc, encoder.encode(t) + end, window):
                    if len(piece[3]) == 4 * window:
                        yield from numbered.rows([piece])
                        continue
                    held.append(piece)
                    size += len(piece[3])
                if len(held) >= buffer or size >= bytes_bound:
                    loose = []
                    for sequence in fit(held):
                        if tight(sequence):
                            yield from numbered.rows(sequence)
                        else:
                            loose += sequence
                    if len(loose) > buffer // 2 or sum(len(p[3]) for p in loose) > bytes_bound // 2:
                        for piece in loose:
                            yield from numbered.rows([piece], False)
                        loose = []
                    held, size = loose, sum(len(p[3]) for p in loose)
        for sequence in fit(held):
            if tight(sequence):
                yield from numbered.rows(sequence)
            else:
                for piece in sequence:
                    yield from numbered.rows([piece], False)

    def second_pass(batches):
        numbered, held, size = Numbered(_SECOND), [], 0
        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)))
            size += batch.column(4).nbytes
            if len(held) >= 2 * buffer or size >= 2 * bytes_bound:
                for sequence in fit(held):
                    yield from numbered.rows(sequence)
                held, size = [], 0
        for sequence in fit(held):
            yield from numbered.rows(sequence)

    rows = keyed(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    packed = materialise(map_arrow(rows, first_pass, _SCHEMA, **_KINDS), "first-pass")
    loose = packed.where("not final")
    count = loose.count()
    again = map_arrow(loose.repartition(max(1, -(-count // buffer)), "sequence_id"), second_pass, _SCHEMA, **_KINDS)
    return packed.where("final").unionByName(again).drop("final")
