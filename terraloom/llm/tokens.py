"""Ids of whole texts under a vocabulary whose pre-tokens never span white space.

The ids come from the tokenizers library. As such a vocabulary treats the parts between blanks one
by one, a worker encodes each distinct part once, keeps a bounded number of them between its tasks,
and joins their ids. Where the vocabulary normalises and splits in the known way, a part of Latin
letters, signs and digits is split into words here and the library's model encodes the words;
every other part goes through the library's whole chain.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import regex

from terraloom.llm.common import kept_in_worker

_CACHED = 48  # longest part, in characters, whose ids are kept
_KEPT = 300_000  # parts, and words, of a generation; two are kept
# Characters whose lower case and composition are one character, whatever stands beside them.
_PLAIN = re.compile("[!-~¡-įı-ſ]*+").fullmatch


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Generations(dict):
    """A bounded cache of two generations: what is used again moves to the newer one, the rest goes."""

    def __init__(self):
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= _CACHED:
            self[key] = out
        return out

    def turn(self) -> None:
        if len(self) > _KEPT:
            self.old = dict(self)
            self.clear()


class _Words(_Generations):
    def __init__(self, model):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, _byte_letters()

    def make(self, word: str) -> bytes:
        raw = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(raw)]).tobytes()


class _Parts(_Generations):
    def __init__(self, tokenizer, find):
        super().__init__()
        self.tokenizer, self.find = tokenizer, find
        self.words = _Words(tokenizer.model)

    def make(self, part: str) -> bytes:
        if not (len(part) <= _CACHED and _PLAIN(part)):
            return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()
        low, words = part.lower(), self.words
        if low.isalpha():
            return words[low]
        if low[-1:] in (".", ",") and low[:-1].isalpha():
            return words[low[:-1]] + words[low[-1]]
        return b"".join(map(words.__getitem__, self.find(low)))


class WordIds:
    """Texts to their ids as little-endian unsigned 32-bit integers, as the library's own call gives them.

    A text that writes out one of the vocabulary's added tokens gets that token's id. Such a text, and
    every text under a vocabulary that does not split in the known way, is encoded by the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        find = None if any(t["normalized"] for t in spec["added_tokens"]) else _splitter(spec)
        self.known = _Parts(self.tokenizer, find) if find else None

    def encode(self, text: str | None) -> bytes:
        """The ids of a text; a null text has none."""
        text = text or ""
        if self.known is None or any(t in text for t in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self.known.turn()
        self.known.words.turn()
        parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.known.__getitem__, parts))


def _splitter(spec: dict):
    """The vocabulary's own split into words, if it normalises and splits in the known way."""
    normal = [(n["type"], n.get("pattern"), n.get("content")) for n in (spec["normalizer"] or {}).get("normalizers", [])]
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    known = normal == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and len(steps) == 2 \
        and (steps[0]["type"], steps[0]["behavior"], steps[0]["invert"]) == ("Split", "Removed", True) \
        and (steps[1]["type"], steps[1]["add_prefix_space"], steps[1]["use_regex"]) == ("ByteLevel", False, False)
    return regex.compile(steps[0]["pattern"]["Regex"]).findall if known else None


def word_ids(path: str) -> WordIds:
    """The worker's encoder, with what it has encoded so far."""
    return kept_in_worker(("word-ids", path), lambda: WordIds(path))
