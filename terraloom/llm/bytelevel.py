"""Ids of whole texts under a byte-level vocabulary in the tokenizers library's file format.

The ids are those that the tokenizers library gives without adding special tokens. Where the file is
a plain byte-level BPE (no normaliser, the standard pattern, ids in the order of the merges), its
merges are ranks, and the tiktoken library applies them to the same pattern several times faster.
Any other vocabulary, and a text that writes out one of the file's added tokens, goes through the
tokenizers library itself.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np

from terraloom.llm.common import kept_in_worker
from terraloom.llm.tokens import _byte_letters


def ranks_of(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary as ranks of byte strings, if the file says no more than ranks do."""
    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    plain = spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"] \
        and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain:
        return None
    byte = {letter: b for b, letter in _byte_letters().items()}
    vocab, added = model["vocab"], {t["content"] for t in spec["added_tokens"]}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    made = [a + b for a, b in merges]
    if set(vocab) - added != {*byte, *made} or len(set(made)) < len(made) or [vocab[m] for m in made] != list(range(256, 256 + len(made))) \
            or sorted(vocab[b] for b in byte) != list(range(256)):
        return None
    return {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}


class ByteLevelIds:
    """Texts to their ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        ranks = ranks_of(spec)
        self.ranked = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None

    def encode(self, text: str | None) -> bytes:
        """The ids of a text; a null text has none."""
        if not text:
            return b""
        if self.ranked and not any(t in text for t in self.added):
            return array("I", self.ranked.encode_ordinary(text)).tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def byte_level_ids(path: str) -> ByteLevelIds:
    """The worker's encoder."""
    return kept_in_worker(("byte-level-ids", path), lambda: ByteLevelIds(path))
