"""Vector best-fit packing: every id in one piece, every capacity kept, few sequences."""

from __future__ import annotations

import functools
from collections import defaultdict

import numpy as np
import pytest

from terraloom.llm import vectorfit
from terraloom.llm.bytelevel import ByteLevelIds

from .helpers import EDGES, documents, prose


@pytest.fixture(scope="module")
def path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def tokenizer(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def library(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


TEXTS = ["", " ", "  two  blanks ", "a\n b\n\nc\t d \r\n", "it's we'll don't 'quoted'", "x, y. z; word,word end.", "ünï 日本語 \U0001f600 ½ x²",
         "a<|endoftext|> b", "\x1c \x1d a\x85 b\xa0c", " lead", "trail ", "one.\nTwo\nthree,\n\nfour\n", "\n", "a$$$ b'%% c_d __ e'll ('f') g's", "Été, über; naïve...", "\nx \ny\n", "é combining ö.", "12 345, 6.7", prose(1, 300), "ß" * 60 + " " + "y" * 70]


def test_ids_equal_the_library(path):
    encoder = ByteLevelIds(path)
    assert encoder.ranked
    for text in [*TEXTS, " " * 30_000 + "x", "\n" * 30_000, "y" * 30_000, prose(2, 20_000)]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(path, text), text
    assert encoder.encode(None) == b""


def test_another_vocabulary_goes_through_the_library(tmp_path):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    one = Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2, "Ġ": 3, "Ġa": 4}, [("a", "b"), ("Ġ", "a")]))
    one.normalizer = normalizers.Lowercase()
    one.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    one.save(str(tmp_path / "t.json"))
    encoder = ByteLevelIds(str(tmp_path / "t.json"))
    assert not encoder.ranked
    assert np.frombuffer(encoder.encode("AB a b"), "<u4").tolist() == one.encode("AB a b", add_special_tokens=False).ids


def check(rows, docs, path, window, max_documents=None, max_attention=None):
    ids = [(i, [*library(path, t), 2]) for i, t in docs]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, parts in pieces.items():
        want = sorted(v for i, v in ids if i == doc)
        parts.sort(key=lambda r: (r.piece, r.ids))
        if len(want) == 1:
            assert [r.piece for r in parts] == list(range(len(parts)))
            assert [r.start for r in parts] == [sum(p.length for p in parts[:n]) for n in range(len(parts))]
            assert [x for r in parts for x in np.frombuffer(r.ids, "<u4").tolist()] == want[0]
            assert len(parts) == 1 or all(r.length == window for r in parts[1:])
        assert sum(r.length for r in parts) == sum(map(len, want))
    assert set(pieces) == {i for i, _ in ids}
    for held in sequences.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == [sum(p.length for p in held[:n]) for n in range(len(held))]
        assert sum(r.length for r in held) <= window
        assert len(held) <= (max_documents or window)
        assert len(held) == 1 or sum(r.length ** 2 for r in held) <= (max_attention or window ** 2)
    return len(sequences)


@pytest.mark.parametrize("options", [{}, {"buffer": 16}, {"rule": "dot"}, {"max_documents": 3}, {"max_attention": 3000, "weights": (1.0, 0.2, 0.5)}])
def test_capacities_and_ids(spark, path, options):
    docs = [*EDGES, *[(100 + n, t) for n, t in enumerate(TEXTS)], *[(200 + n, prose(n, 5 + 7 * n % 200)) for n in range(150)]]
    rows = vectorfit.pack_best_fit(documents(spark, docs), window=128, **options).collect()
    many = check(rows, docs, path, 128, options.get("max_documents"), options.get("max_attention"))
    if not options:
        assert many <= 1.02 * sum(r.length for r in rows) / 128 + 1


def test_empty_table(spark):
    df = vectorfit.pack_best_fit(documents(spark, [(1, "x")]).limit(0))
    assert df.count() == 0 and df.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_rule_against_plain_loops(rule):
    rng = np.random.default_rng(4)
    for _ in range(30):
        tokens, documents_, attention = 60, int(rng.integers(2, 6)), int(rng.integers(900, 3600))
        sizes, weights = rng.integers(1, 60, 80), (1.0, 0.3, 0.4)
        bins, want = [], np.empty(80, np.int64)
        for i in sorted(range(80), key=lambda i: -sizes[i]):
            p = np.array([sizes[i], 1, sizes[i] ** 2], float)
            factor = np.array(weights) / np.array([tokens, documents_, attention], float) ** 2
            fits = [n for n, room in enumerate(bins) if (room >= p).all()]
            key = (lambda n: factor @ (bins[n] - p) ** 2) if rule == "norm" else (lambda n: -(factor * p) @ bins[n])
            best = min(fits, key=lambda n: (round(key(n), 12), n), default=None)
            if best is None:
                bins.append(np.maximum(np.array([tokens, documents_, attention]) - p, 0))
                best = len(bins) - 1
            else:
                bins[best] = bins[best] - p
            want[i] = best
        got = vectorfit.vector_best_fit(sizes, (tokens, documents_, attention), weights, rule)
        assert len(set(got)) == len(set(want))
        used = np.bincount(got, sizes).max(), np.bincount(got).max()
        assert used[0] <= tokens and used[1] <= documents_
    with pytest.raises(ValueError):
        vectorfit.vector_best_fit(np.array([61]), (60, 1, 1))
    with pytest.raises(ValueError):
        vectorfit.vector_best_fit(np.array([6]), (60, 1, 1), rule="first")
