"""Exact deduplication: two Bloom passes find hashes that may repeat, and only their rows shuffle.

Pass one maps every text to a few bit positions inside one block of a Bloom filter and keeps the
positions that two or more rows hit. Pass two tests every row: a row with a position hit only once
has no equal and passes straight through; the others are grouped by the SHA-256 of their text.
All work is DataFrame functions.

Null texts count as empty texts, and empty texts are equal to each other. Of equal texts the row
with the largest id stays (a null id is the smallest); of repeated rows exactly one stays. An
empty table gives an empty result. Further columns never enter the decision.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import packed_rows, quoted, text_of, unpacked_rows
from terraloom.session import materialise

BLOCK_BITS = 1 << 15  # one block: 512 words of 64 bits
_WORDS = BLOCK_BITS // 64
_HASHES = 3


def repeated_positions(hashes: DataFrame, rows: int, bits_per_row: int = 16, max_bytes: int = 64 << 20) -> tuple[DataFrame, int]:
    """The filter as rows ``(block, words)`` and its number of blocks, from 64-bit hashes ``h``.

    It never exceeds ``max_bytes``, which is what a task holds of it; with more rows than fit,
    more rows test positive and take the shuffle, and the result stays the same.
    """
    blocks = max(1, min(1 << math.ceil(math.log2(max(1, rows * bits_per_row / BLOCK_BITS))), max_bytes * 8 // BLOCK_BITS))
    hit = (hashes.select(_block("h", blocks).alias("block"), F.explode(F.array_distinct(F.array(*_positions("h")))).alias("bit"))
           .groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    words = hit.groupBy("block", F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % 64)).alias("bits"))
    made = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    filled = made.select("block", F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.coalesce(F.col("held")[i], F.lit(0).cast("long"))).alias("words"))
    return filled, blocks


def _block(h: str, blocks: int) -> Column:
    return F.pmod(F.col(h), F.lit(blocks)).cast("int")


def _positions(h: str) -> list[Column]:
    """Bit positions inside a block, from parts of the hash above the block number."""
    return [F.shiftrightunsigned(F.xxhash64(F.col(h), F.lit(i)), 49).cast("int") for i in range(_HASHES)]


def _may_repeat(rows: DataFrame, filled: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with a column ``again``: whether every position of the row was hit at least twice."""
    tested = rows.withColumn("block", _block("h", blocks)).join(F.broadcast(filled), "block", "left")
    bits = [F.call_function("getbit", F.get("words", F.shiftright(p, 6)), p % 64) == 1 for p in _positions("h")]
    again = bits[0]
    for b in bits[1:]:
        again = again & b
    return tested.withColumn("again", F.coalesce(again, F.lit(False))).drop("block", "words")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", max_filter_bytes: int = 64 << 20) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = materialise(
        docs.select(F.col(quoted(id_column)).alias("doc_id"), F.sha2(text_of(text).cast("binary"), 256).alias("text_sha256"),
                    F.monotonically_increasing_id().alias("place"))
        .withColumn("h", F.xxhash64("text_sha256")), "digests")
    filled, blocks = repeated_positions(digests, digests.count(), max_bytes=max_filter_bytes)
    tested = _may_repeat(digests, materialise(filled, "bloom"), blocks)
    again = tested.where("again")
    groups = materialise(
        again.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "place")).alias("top"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1"), "groups")
    alone = tested.where(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    # The groups are a written table of one row a group, so adaptive execution can split a large group's rows.
    grouped = again.join(groups, "text_sha256", "left").select(
        "doc_id", F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("top.place") == F.col("place"), F.lit(True)).alias("kept"), "text_sha256")
    return alone.unionByName(grouped)


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text", max_filter_bytes: int = 64 << 20) -> DataFrame:
    """The documents that stay, with all their columns; rows without a possible equal never shuffle."""
    digest = F.sha2(text_of(text).cast("binary"), 256)
    hashes = materialise(docs.select(F.xxhash64(digest).alias("h")), "hashes")
    filled, blocks = repeated_positions(hashes, hashes.count(), max_bytes=max_filter_bytes)
    rows = packed_rows(docs, digest=digest, key=F.col(quoted(id_column))).withColumn("h", F.xxhash64("digest"))
    tested = _may_repeat(rows, materialise(filled, "bloom"), blocks)
    # max_by combines before the shuffle, so a group of copies sends one row a task.
    kept = tested.where("again").groupBy("digest").agg(F.max_by("row", F.struct("key", F.lit(0))).alias("row"))
    return unpacked_rows(tested.where(~F.col("again")).select("row").unionByName(kept.select("row")), docs.columns)
