"""Packing, token-id files, byte-level BPE."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import EDGES, documents, prose
from tokenizers import Tokenizer

from terraloom.llm import bytebpe, packing, repair
from terraloom.llm.tokens import WordIds, word_vocabulary

TOKENIZER = Tokenizer.from_file(word_vocabulary())
RANKS = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TABLE = bytebpe.perfect_hash(RANKS)
ODD = st.text(st.one_of(st.sampled_from(" \n\t\r  \x1c\x85'.,-_AaZzßéÅΣς1٣²"), st.characters(exclude_categories=["Cs"])), max_size=60)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_ids_by_parts_equal_ids_of_the_whole_text(text):
    words = test_ids_by_parts_equal_ids_of_the_whole_text.words
    assert np.frombuffer(words.encode(text), "<u4").tolist() == plain_ids(text)


test_ids_by_parts_equal_ids_of_the_whole_text.words = WordIds(word_vocabulary())


def test_word_ids_of_whole_texts():
    texts = [t for _, t in EDGES] + ["special <|endoftext|> inside", "<|startoftext|>x<|endoftext|>", "<|endoftext", "<|ENDOFTEXT|>", "a b"]
    assert 49407 in plain_ids(texts[-5])
    assert [np.frombuffer(x, "<u4").tolist() for x in map(WordIds(word_vocabulary()).encode, texts)] == [plain_ids(t) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_ids_under_any_vocabulary(name):
    """A byte-level vocabulary has tokens that begin with a blank: its texts are not cut at blanks."""
    path = public_tokenizers.path(name)
    own = Tokenizer.from_file(path)
    texts = ["the cat sat", " the  cat\n\nsat ", "l'été <|endoftext|> à l'eau", "", "x" * 5000, None]
    assert [np.frombuffer(WordIds(path).encode(t), "<u4").tolist() for t in texts] == [own.encode(t or "", add_special_tokens=False).ids for t in texts]


def check_packing(rows, pieces, window):
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(plain_ids(t) + [1])
    seen, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        got = np.frombuffer(p.ids, "<u4").tolist()
        assert len(got) == p.length > 0
        seen[p.doc_id].append((p.start, p.doc_tokens, got))
        sequences[p.sequence_id].append((p.offset, p.length))
    for i, wanted in ids.items():
        if len(wanted) == 1:
            assert sum((g for _, _, g in sorted(seen[i])), []) == wanted[0]
            assert all(n == len(wanted[0]) for _, n, _ in seen[i])
        assert sum(len(g) for _, _, g in seen[i]) == sum(map(len, wanted))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@pytest.mark.parametrize("window", [64, 2048])
def test_packing_covers_every_id_once_without_padding(spark, window):
    rows = EDGES + [(100 + i, prose(i, random.Random(i).randrange(1, 400))) for i in range(300)]
    assert check_packing(rows, packing.pack(documents(spark, rows), window=window).collect(), window) == 0


def test_level_rule_minimises_the_sum_of_squares():
    rng = random.Random(4)
    levels = packing.LevelArray(32)
    for _ in range(3000):
        size = rng.randrange(1, 32)
        count = levels.count.copy()

        def after(level):
            c = count.copy()
            if level:
                c[level] -= 1
            if level + size < 32:
                c[level + size] += 1
            return int((c[1:32] ** 2).sum())
        choices = [lv for lv in range(0, 33 - size) if lv == 0 or count[lv]]
        assert after(levels.level_for(size)) == min(map(after, choices))
        levels.add((0, size, 0, bytes(4 * size)), size)
        assert [len(o) for o in levels.open] == levels.count[:32].tolist()


def test_many_open_windows_are_filled_up_early(spark, monkeypatch):
    monkeypatch.setattr(packing, "_OPEN", 3)
    rows = [(i, prose(i, 20 + i % 50)) for i in range(120)]
    assert check_packing(rows, packing.pack(documents(spark, rows), window=128).collect(), 128) == 0


def test_packing_an_empty_table(spark):
    assert packing.pack(documents(spark, [])).collect() == []


def test_grammar_gives_back_every_document_and_slice():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 50, 400)
    docs = [np.append(np.concatenate([base[a:a + 40] for a in rng.integers(0, 360, rng.integers(0, 30))] or [base[:0]]), 2) for _ in range(60)]
    ends = np.zeros(sum(map(len, docs)), bool)
    ends[np.cumsum([len(d) for d in docs]) - 1] = True
    g = repair.compress(np.concatenate(docs), ends, 50, rounds=8, least=4)
    assert len(g.rules) and len(g.symbols) < len(ends) / 2 and int(g.ends.sum()) == len(docs)
    table = repair.expansions(g.rules, repair.terminal_bytes(50))
    assert [len(x) // 4 for x in table[50:]] == g.lengths.tolist()
    at = 0
    for doc, stop in zip(docs, np.flatnonzero(g.ends) + 1):
        symbols = g.symbols[at:stop]
        assert np.frombuffer(b"".join(table[s] for s in symbols), "<u4").tolist() == doc.tolist()
        a, b = sorted(rng.integers(0, len(doc) + 1, 2))
        assert repair.decode_slice(symbols, g.rules, g.lengths, 50, int(a), int(b)).tolist() == doc[a:b].tolist()
        at = stop


@pytest.mark.parametrize("shard_ids", [200, 1 << 20])
def test_token_files_round_trip_in_id_order(spark, tmp_path, shard_ids):
    rows = [r for r in EDGES if r[0] != 3] + [(100 + i * 7 % 300, prose(i, 40)) for i in range(300)]
    out = str(tmp_path / "tokens")
    repair.write_token_files(documents(spark, rows), out, shard_ids=shard_ids)
    got = sorted(repair.read_token_files(spark, out).collect(), key=lambda r: r.start)
    rows.sort(key=lambda r: (r[0] is not None, r[0]))
    at = 0
    for r, (i, t) in zip(got, rows, strict=True):
        want = plain_ids(t) + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (i, at, len(want)) and np.frombuffer(r.ids, "<u4").tolist() == want
        at += len(want)
    part = repair.read_token_files(spark, out, (100, 110)).collect()
    assert {(r.doc_id, r.start) for r in part} == {(r.doc_id, r.start) for r in got if r.doc_id and 100 <= r.doc_id <= 110}


def test_token_files_with_equal_ids_and_empty_tables(spark, tmp_path):
    repair.write_token_files(documents(spark, [(3, "a"), (3, "a"), (3, "b")]), str(tmp_path / "a"))
    got = sorted((r.start, r.n_tokens) for r in repair.read_token_files(spark, str(tmp_path / "a")).collect())
    assert got == [(0, 2), (2, 2), (4, 2)]
    repair.write_token_files(documents(spark, []), str(tmp_path / "b"))
    assert repair.read_token_files(spark, str(tmp_path / "b")).collect() == []


def test_perfect_hash_is_minimal_and_exact():
    assert sorted(TABLE.slots) == sorted(RANKS) and len(TABLE.slots) == len(RANKS)
    assert all(TABLE.get(t) == r for t, r in RANKS.items())
    assert TABLE.get(b"surely no such token") is None
    assert bytebpe.perfect_hash({b"a": 5}).get(b"a") == 5


BPE = bytebpe.ByteBpe(TABLE, public_tokenizers.PATTERN)


@settings(max_examples=500, deadline=None)
@given(ODD)
def test_byte_bpe_equals_tiktoken_and_decodes(text):
    ids = BPE.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == TIKTOKEN.encode_ordinary(text)
    assert BPE.decode(ids) == text.encode()


def test_byte_bpe_of_long_words():
    rng = random.Random(8)
    for text in ("a" * 3000, "".join(rng.choice("abcdeft") for _ in range(4000)), " " * 2000 + "x", "ab" * 999):
        assert np.frombuffer(BPE.encode(text), "<u4").tolist() == TIKTOKEN.encode_ordinary(text)


def test_byte_bpe_over_a_table(spark):
    got = bytebpe.encode(documents(spark, EDGES)).collect()
    want = sorted((sha256(np.array(TIKTOKEN.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest(), (t or "").encode()) for _, t in EDGES)
    assert sorted((sha256(r.ids).hexdigest(), bytes(r.decoded)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert bytebpe.encode(documents(spark, [])).collect() == []


def test_crc_of_ids_is_that_of_packed_integers(spark):
    ids = np.array([1, 2, 70000], "<u4").tobytes()
    assert spark.createDataFrame([(ids,)], "ids binary").selectExpr("crc32(ids) c").first().c == zlib.crc32(ids)
