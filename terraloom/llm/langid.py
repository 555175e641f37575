"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the character n-grams of each lower-cased word with its boundaries, hashed into a
table of embeddings. A text's vector is the mean of its n-grams' embeddings; a linear softmax maps
it to languages. Embeddings and weights are learned by stochastic gradient descent in numpy from a
bounded sample of labelled texts. Scores are calibrated by a temperature fitted on rows of that
sample which training leaves out, and a document is rejected if its score is too low.

A null text and a text without a letter give ``und`` with score 0 and are rejected. Without any
labelled text every document is ``und``. Whole texts are scored, in pieces of bounded size. Ties
between languages go to the first in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.llm.common import map_arrow, packed_rows, quoted, text_of, unpacked_rows

BUCKETS = 1 << 16
SIZES = (2, 3, 4)
_STEPS = 4000  # gradient steps at least
_PIECE = 1 << 19  # characters featurised at once
_MULTIPLIER = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # buckets x languages: embedding times weights
    bias: np.ndarray
    temperature: float
    reject_below: float


def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def subwords(texts: list[str], letter: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first's number, hashed n-grams, and where each text's n-grams start.

    A text longer than a piece comes in several runs, cut so that no n-gram is lost or doubled.
    """
    width = max(SIZES)
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        t = " " + t.lower() + " "
        if size and size + len(t) > _PIECE:
            yield first, *_hashed(held, letter)
            held, size, first = [], 0, i
        if len(t) > _PIECE:
            for at in range(0, len(t), _PIECE):
                yield i, *_hashed([t[at:at + _PIECE + width - 1]], letter, min(_PIECE, len(t) - at))
            first = i + 1
            continue
        held.append(t)
        size += len(t)
    if held:
        yield first, *_hashed(held, letter)


def _hashed(texts: list[str], letter: np.ndarray, starts_below: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """n-grams by text and, inside a text, by size and place; those that start below a place only."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum([0] + [len(t) for t in texts[:-1]])
    is_letter = letter[codes]
    c = np.where(is_letter, codes, np.uint32(0))
    grams, owners = [], []
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.append(begin, len(codes))))
    for n in SIZES:
        m = len(c) - n + 1
        if m <= 0:
            continue
        ok = is_letter[:m] | is_letter[1:] if n == 2 else np.ones(m, bool)
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h = (h ^ c[k:k + m]) * _MULTIPLIER
            h ^= h >> np.uint32(15)
            if 0 < k < n - 1:
                ok &= is_letter[k:k + m]
        if starts_below is not None:
            ok[starts_below:] = False
        at = np.flatnonzero(ok)
        grams.append(((h[at] * _MIX) >> np.uint32(16)).astype(np.int32))
        owners.append(owner[at])
    if not grams:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    gram, own = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(own, kind="stable") if len(texts) > 1 else slice(None)
    return gram[order], np.searchsorted(own[order], np.arange(len(texts) + 1))


def _sums(texts: list[str], table: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of table rows and number of n-grams for each text."""
    total, count = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts))
    for first, gram, bounds in subwords(texts, letter):
        n = np.diff(bounds)
        some = np.flatnonzero(n)
        if len(some):
            total[first + some] += np.add.reduceat(table[gram], bounds[:-1][some], axis=0)
            count[first:first + len(n)] += n
    return total, count


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sampled_texts(docs: DataFrame, by: str, per_class: int, max_rows: int, id_column: str, text: str, max_chars: int) -> list[tuple]:
    """A bounded sample ``(class, text)`` for fitting: for each class the ids with the smallest hashes.

    At most ``per_class`` ids a class, ``max_rows`` classes and rows, and texts of at most ``max_chars``.
    """
    ids = docs.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(by)).alias("class"), F.length(text_of(text)).alias("n"))
    ids = ids.where(F.col("id").isNotNull() & F.col("class").isNotNull() & F.col("n").between(1, max_chars)).drop("n")
    counts = ids.groupBy("class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "class").limit(max_rows)
    # A class keeps about four times the ids it needs, so that the window below sees as few of a very frequent class as of others.
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 31)) * F.col("n") < F.lit((1 << 31) * 4.0 * per_class)
    order = Window.partitionBy("class").orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 31)), "id")
    chosen = (ids.join(F.broadcast(counts), "class").where(share).withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_class)
              .select("id").distinct().limit(max_rows))
    rows = (docs.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(by)).alias("class"), text_of(text).alias("t"))
            .join(F.broadcast(chosen), "id", "left_semi").where(F.col("class").isNotNull() & F.length("t").between(1, max_chars)).limit(max_rows))
    return sorted((r["class"], r["t"]) for r in rows.collect())


def train_languages(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 400,
                    max_rows: int = 10_000, max_chars: int = 20_000, dim: int = 16, epochs: int = 6, rate: float = 0.5, seed: int = 1,
                    reject_below: float = 0.3) -> LanguageModel:
    """Fit on a sample of at most ``per_language`` texts a language and ``max_rows`` in all.

    Every fifth sampled text is left out of training; these texts and runs of one to eight of their
    words fit the temperature that makes scores probabilities. Documents whose score is below
    ``reject_below`` are rejected: the model is then far more likely wrong than right.
    """
    rows = sampled_texts(docs.where(F.col(quoted(text)).isNotNull()), lang, per_language, max_rows, id_column, text, max_chars)
    return fit_languages(rows, dim, epochs, rate, seed, reject_below)


def fit_languages(rows: list[tuple], dim: int = 16, epochs: int = 6, rate: float = 0.5, seed: int = 1, reject_below: float = 0.3) -> LanguageModel:
    """The numpy part of :func:`train_languages`, from pairs of language and text."""
    languages = tuple(sorted({r[0] for r in rows}))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    letter, rng = letters(), np.random.default_rng(seed)
    bags, label, texts = [], [], []
    for name, t in rows:
        gram = np.concatenate([g for _, g, _ in subwords([t], letter)] or [np.zeros(0, np.int32)])
        if len(gram):
            bucket, n = np.unique(gram, return_counts=True)
            bags.append((bucket, (n / n.sum())[:, None]))
            label.append(languages.index(name))
            texts.append(t)
    if not bags:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    held = [i for i in range(len(bags)) if i % 5 == 4]
    used = [i for i in range(len(bags)) if i % 5 != 4]
    emb = rng.normal(0, 1 / dim, (BUCKETS, dim))
    weight, bias = np.zeros((dim, len(languages))), np.zeros(len(languages))
    epochs = max(epochs, -(-_STEPS // max(1, len(used))))  # few texts are gone through more often
    steps, done = epochs * len(used), 0
    for _ in range(epochs):
        for i in rng.permutation(used):
            eta = rate * (1 - done / steps)
            done += 1
            bucket, share = bags[i]
            x = (emb[bucket] * share).sum(0)
            g = _softmax(x @ weight + bias)
            g[label[i]] -= 1
            back = weight @ g
            weight -= eta * np.outer(x, g)
            bias -= eta * 0.1 * g
            emb[bucket] -= eta * share * back * len(bucket) ** 0.5
    table = (emb @ weight).astype(np.float32)
    # Calibration sees the texts left out and, since short texts are the doubtful ones, a few words of each.
    pieces, y = [], []
    for i in held or used:
        words = texts[i].split()
        for n in (0, 1, 2, 4, 8):
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            pieces.append(" ".join(words[at:at + n]) if n else texts[i])
            y.append(label[i])
    total, count = _sums(pieces, table, letter)
    y = np.array(y)[count > 0]
    z = (total[count > 0] / count[count > 0, None]) + bias
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    return LanguageModel(languages, table, bias, temperature, reject_below)


def predict_texts(texts: list, model: LanguageModel, letter: np.ndarray) -> list[tuple[str, float]]:
    """``(language, calibrated score)`` of each text."""
    if not model.languages:
        return [("und", 0.0)] * len(texts)
    total, count = _sums([t or "" for t in texts], model.table, letter)
    p = _softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
    best = p.argmax(1)
    return [(model.languages[b], float(p[i, b])) if count[i] else ("und", 0.0) for i, b in enumerate(best)]


def identify_languages(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, rejected``."""
    def predict(batches):
        letter = letters()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (name, score) in zip(ids, predict_texts(texts, model, letter)):
                yield i, name, score, name == "und" or score < model.reject_below

    id_type = docs.select(F.col(quoted(id_column)).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return map_arrow(id_type, predict, "doc_id long, lang_pred string, score double, rejected boolean",
                     doc_id=pa.int64(), lang_pred=pa.string(), score=pa.float64(), rejected=pa.bool_())


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents whose language is not rejected, with all their columns."""
    def judge(batches):
        letter = letters()
        for batch in batches:
            found = predict_texts(batch.column(0).field(place).to_pylist(), model, letter)
            yield batch.filter(pa.array([name != "und" and score >= model.reject_below for name, score in found], pa.bool_()))

    place, rows = docs.columns.index(text), packed_rows(docs)
    return unpacked_rows(rows.mapInArrow(judge, rows.schema), docs.columns)
