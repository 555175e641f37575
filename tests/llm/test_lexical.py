"""Ranked lexical search against scores computed document by document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.llm import lexical

from .helpers import EDGES, WORDS, documents, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(rows, items, k):
    docs = [(i, Counter(t)) for i, text in rows if (t := terms(text))]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        asked, found = Counter(terms(text)), []
        for doc, count in docs:
            m = 75 + 25 * sum(count.values()) * n // total
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * count[t] // (1000 * count[t] + 12 * m)) for t, q in asked.items() if t in count)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k])]
    return out


def many(seed, count):
    rng = random.Random(seed)
    rows = [(i, prose(seed * 1000 + i, int(2 ** rng.uniform(0, 10)))) for i in range(count)]
    return rows + [(count + i, rows[7][1]) for i in range(40)] + [(count + 100, "lamp " * 500 + "Ünïcode ÜNÏCODE lamp_lamp")]


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (str(r[0]), r[1]))


@pytest.mark.parametrize("k, pairs, at_once", [(20, lexical.PAIRS, 1024), (3, 256, 2), (1000, 256, 1024)])
def test_ranks_equal_brute_force(spark, k, pairs, at_once):
    rows = many(3, 250)
    items = [(1, rows[7][1]), (2, "lamp lamp river"), (3, "Ünïcode x"), (4, "stone, winter; GARDEN!"), (5, None), (6, ""), (7, "nowhere at all"), (1, rows[7][1])]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"doc_id": F.lit("x"), "score": F.lit(1)})
    assert got(lexical.search(documents(spark, rows), asked, k, pairs=pairs, items_at_once=at_once)) == \
        sorted(ranked(rows, items, k), key=lambda r: (str(r[0]), r[1]))


def test_rows_of_edges(spark):
    items = [(None, "no id twice"), (1, "the same row 日本語"), (2, prose(7, 30))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical.search(documents(spark, EDGES), asked)) == sorted(ranked(EDGES, items, 20), key=lambda r: (str(r[0]), r[1]))


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "one")]), spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(documents(spark, [(1, None), (2, "...")]), items).count() == 0
    assert lexical.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_and_most_documents_are_excluded(spark):
    rows = many(5, 400)
    index = lexical.build_index(documents(spark, rows), pairs=4096)
    documents_, terms_ = index.agg(F.sum("documents"), F.sum("terms")).first()
    asked = sorted(w.encode() for w in {*WORDS, "lamp", "absent"})
    hashes, scored, beyond = lexical.hash_terms(asked), 0, 0
    for row in index.collect():
        block = lexical.Block(row.asDict(), documents_, terms_)
        may = block.presence(hashes)
        local = np.array([block.vocabulary.get(t, -1) for t in asked])
        weights = np.arange(1, len(asked) + 1, dtype=np.int64)
        bound = sum(g * (weights @ b) for g, b in zip(block.gain, may))
        for d in range(len(block.ids)):
            exact = block.scores(d, local[local >= 0], weights[local >= 0])
            assert bound[d] >= exact
            scored += 1
            beyond += bound[d] > 1.5 * exact + 1000
    assert scored == len([r for r in rows if terms(r[1])]) and beyond < 0.2 * scored
