"""Exact copies, near copies by SimHash, connected components."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from llm.helpers import EDGES, documents, prose
from pyspark.sql import functions as F

from terraloom.llm import exact, simhash
from terraloom.llm.components import connected_components


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_exact_groups_keep_the_largest_id_of_equal_texts(spark):
    rows = [r for r in EDGES if r[0] not in (None, 3)] + [(100 + i, "hot") for i in range(500)] + [(900 + i, prose(i, 5)) for i in range(300)]
    got = {r.doc_id: r for r in exact.exact_groups(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    size = Counter(t or "" for _, t in rows)
    top = {}
    for i, t in rows:
        top[t or ""] = max(top.get(t or "", i), i)
    for i, t in rows:
        t = t or ""
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (top[t], size[t], top[t] == i, sha256(t.encode()).hexdigest())


def test_exact_keeps_one_of_repeated_rows_and_null_ids_lose(spark):
    docs = documents(spark, [(3, "a"), (3, "a"), (None, "a"), (None, "b"), (None, "b")])
    got = exact.exact_groups(docs).collect()
    assert sorted((r.text_sha256, r.kept) for r in got).count((sha256(b"a").hexdigest(), True)) == 1
    assert sum(r.kept for r in got) == 2 and {r.keep_id for r in got if r.group_size == 3} == {3}
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.text, r.doc_id) for r in left.collect()) == [("a", 3), ("b", None)]


@pytest.mark.parametrize("filter_bytes", [1 << 12, 64 << 20])
def test_exact_result_does_not_depend_on_the_filter_size(spark, filter_bytes):
    rows = [(i, prose(i % 1500, 4)) for i in range(3000)]
    got = exact.exact_groups(documents(spark, rows), max_filter_bytes=filter_bytes)
    want = {}
    for i, t in rows:
        want[t] = max(want.get(t, i), i)
    assert {r.doc_id: r.keep_id for r in got.collect()} == {i: want[t] for i, t in rows}


def test_bloom_passes_most_single_rows_through(spark):
    h = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    filled, blocks = exact.repeated_positions(h, 20_000)
    assert exact._may_repeat(h, filled, blocks).where("again").count() < 400


def test_exact_on_an_empty_table(spark):
    docs = documents(spark, [])
    assert exact.exact_groups(docs).collect() == [] and exact.drop_exact_copies(docs).collect() == []


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1200)] + [(5, 5), (1, 2), (2, 1), (1, 2)]
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    links = [(a * 7919 % 4001 - 2000, b * 7919 % 4001 - 2000) for a, b in links]
    df = spark.createDataFrame(links + [(None, 1)], "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in connected_components(df).collect()} == classes(nodes, [p for p in links if p[0] != p[1]])


def test_components_without_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def variants(n, base_words=120, changed=1):
    rng, base = random.Random(n), prose(99, base_words).split()
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(changed):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("list_rows", [1 << 20, 16])
def test_near_duplicates_match_brute_force(spark, list_rows):
    rows = [r for r in EDGES if r[0] is not None and len(r[1] or "") < 10_000]
    rows += [(100 + i, t) for i, t in enumerate(variants(150))] + [(400 + i, prose(i, 3 + i % 50)) for i in range(200)] + [(800, "Two words"), (801, "two  WORDS")]
    prints = {}
    for i, t in rows:
        prints.setdefault(plain_fingerprint(t), []).append(i)
    fps = sorted(prints)
    links = [(a, b) for k, a in enumerate(fps) for b in fps[k + 1:] if (a ^ b).bit_count() <= 3]
    assert len(links) > 50
    root = classes(fps, links)
    least = {}
    for f in fps:
        least[root[f]] = min([least.get(root[f], 10 ** 9), *prints[f]])
    got = simhash.near_duplicates(documents(spark, rows), list_rows=list_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        f = int(r.fingerprint, 16)
        assert r.doc_id in prints[f] and r.component_id == least[root[f]]


def test_spanning_links_connect_what_pairs_connect():
    rng = np.random.default_rng(5)
    center = rng.integers(-2 ** 63, 2 ** 63 - 1, dtype=np.int64)
    values = np.unique(np.array([center ^ np.int64(1 << int(rng.integers(0, 60)) | 1 << int(rng.integers(0, 60))) for _ in range(200)]
                                + list(rng.integers(-2 ** 63, 2 ** 63 - 1, 100, dtype=np.int64))))
    pairs = [(int(a), int(b)) for k, a in enumerate(values) for b in values[k + 1:] if int(np.bitwise_count((a ^ b).view(np.uint64))) <= 3]
    nodes = [int(v) for v in values]
    links = simhash.spanning_links(values)
    assert classes(nodes, pairs) == classes(nodes, links) and len(links) < len(values)


def test_fingerprint_of_a_text_longer_than_a_piece(monkeypatch):
    text = prose(1, 1000)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_SHINGLES", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_drop_near_duplicates_keeps_one_of_each_class(spark):
    rows = [(10 + i, t) for i, t in enumerate(variants(40, 400))] + [(1, "other text here"), (2, None), (3, ""), (4, "a row twice"), (4, "a row twice"), (None, "no id")]
    docs = documents(spark, rows)
    comp = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = [r.doc_id for r in left.collect()]
    assert sorted(k for k in kept if k) == sorted(set(v for v in comp.values() if v)) and kept.count(None) == 1


def test_near_duplicates_on_an_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).collect() == [] and simhash.drop_near_duplicates(docs).collect() == []
