"""Packing of documents into training windows by the sum-of-squares rule.

Windows fill online. For each document the level array holds how many windows are filled to each
level; the document goes to the level at which the sum of squared counts over the partly filled
levels becomes least, which keeps levels of all sizes in stock and few windows open. A document
longer than the window is cut into full windows first. Each task packs what it reads, so nothing
shuffles. At a task's end the fullest open windows are filled up with pieces of the emptiest, and
the last one is cut into sequences whose lengths are powers of two, which need no padding.

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
from terraloom.llm.tokens import word_ids, word_vocabulary

_OPEN = 8192  # open windows, beyond which a task fills them up early
_TASK_BITS = 40  # sequence numbers of a task


class LevelArray:
    """Open windows by level and the rule that chooses among them."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]

    def level_for(self, size: int) -> int:
        """The level to add ``size`` to; 0 opens a window. Ties go to the fullest."""
        last = self.window - size
        after = 2 * self.count[size:self.window + 1] + 1
        after[last] = 0  # a full window is no longer counted
        before = 2 * self.count[:last + 1] - 1
        before[0] = 0
        change = after - before
        change[1:][self.count[1:last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def add(self, piece: tuple, size: int) -> list | None:
        """Place a piece; the window, if that fills it."""
        level = self.level_for(size)
        if level:
            held = self.open[level].pop()
            self.count[level] -= 1
        else:
            held = []
        held.append(piece)
        if level + size == self.window:
            return held
        self.open[level + size].append(held)
        self.count[level + size] += 1
        return None

    def drain(self) -> tuple[list[list], list]:
        """Empty the array: windows filled up with each other's pieces, and what remains over."""
        left = [(level, held) for level in range(self.window - 1, 0, -1) for held in self.open[level]]
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0
        full, i, j = [], 0, len(left) - 1
        while i < j:
            level, held = left[i]
            spare_level, spare = left[j]
            while level < self.window and spare:
                piece, rest = cut(spare.pop(), self.window - level)
                held.append(piece)
                level += len(piece[3]) // 4
                spare_level -= len(piece[3]) // 4
                if rest:
                    spare.append(rest)
            left[i], left[j] = (level, held), (spare_level, spare)
            if level == self.window:
                full.append(held)
                i += 1
            if not spare:
                j -= 1
        return full, left[i][1] if i == j else []


def cut(piece: tuple, size: int) -> tuple[tuple, tuple | None]:
    """The first ``size`` ids of a piece, and the rest."""
    doc, total, start, ids = piece
    if len(ids) <= 4 * size:
        return piece, None
    return (doc, total, start, ids[:4 * size]), (doc, total, start + size, ids[4 * size:])


def powers_of_two(pieces: list[tuple]):
    """Sequences whose lengths are falling powers of two, from the pieces of one window."""
    left = sum(len(p[3]) for p in pieces) // 4
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            piece, rest = cut(pieces.pop(), room)
            sequence.append(piece)
            room -= len(piece[3]) // 4
            if rest:
                pieces.append(rest)
        yield sequence


def pack(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: ``doc_id, doc_tokens, start, length, ids, sequence_id, offset``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers. The pieces of a sequence
    ordered by ``offset`` make up its ids without a gap.
    """
    path = path or word_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        words, levels = word_ids(path), LevelArray(window)
        number = (TaskContext.get().partitionId() << _TASK_BITS) - 1

        def numbered(sequences):
            nonlocal number
            for sequence in sequences:
                number += 1
                offset = 0
                for doc, total, start, ids in sequence:
                    yield doc, total, start, len(ids) // 4, ids, number, offset
                    offset += len(ids) // 4

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), map(words.encode, batch.column(1).to_pylist())):
                rest = (doc, len(ids) // 4 + 1, 0, ids + end)
                while rest and len(rest[3]) >= 4 * window:
                    piece, rest = cut(rest, window)
                    yield from numbered([[piece]])
                if rest:
                    done = levels.add(rest, len(rest[3]) // 4)
                    if done:
                        yield from numbered([done])
                    elif int(levels.count.sum()) > _OPEN:
                        full, last = levels.drain()
                        yield from numbered(full)
                        if last:
                            for piece in last:
                                levels.add(piece, len(piece[3]) // 4)
        full, last = levels.drain()
        yield from numbered(full)
        yield from numbered(powers_of_two(last))

    rows = keyed(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, run, "doc_id long, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long",
                     doc_id=pa.int64(), doc_tokens=pa.int64(), start=pa.int64(), length=pa.int64(), ids=pa.binary(),
                     sequence_id=pa.int64(), offset=pa.int64())
