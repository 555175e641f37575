"""Quality scores by compression: zstandard dictionaries of good and of bad text compete.

Two dictionaries are trained, one on texts labelled good and one on texts labelled bad. A text is
cut into blocks, each is compressed with either dictionary, and the difference of the summed sizes
over the text's bytes tells which kind it resembles. A logistic map, fitted on sampled texts that
the dictionaries have not seen, turns the difference into a probability; it also sees how far the
text compresses at all and how short it is, since a short text shows little difference.

A null text is scored as the empty text: no difference, so the score of the shortest texts.
If one label is missing from the sample, the score is the share of good labels in it (one half
without labels). Whole texts are scored; repeated documents get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import crc_bucket, keyed, map_arrow, packed_rows, quoted, unpacked_rows
from terraloom.llm.langid import sampled_texts

BLOCK = 512  # bytes compressed at once: small, so that the dictionary matters
LEVEL = 3
DICTIONARY = 64 << 10
_SHORT = 128  # bytes over which a text stops counting as short


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # intercept, difference, compressed share, shortness
    prior: float


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))

    def features(self, text: str | None) -> tuple[float, float, float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return 0.0, 1.0, 1.0
        blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.compressors)
        return (bad - good) / len(raw), min(1.0, good / len(raw)), float(np.exp(-len(raw) / _SHORT))


def fit_quality(rows: list[tuple], sample_bytes: int = 8 << 20) -> QualityModel:
    """A model from pairs of label (1 good, 0 bad) and text; every fifth text only calibrates.

    Each dictionary sees at most ``sample_bytes`` of text.
    """
    prior = float(np.mean([r[0] for r in rows])) if rows else 0.5
    seen = {0: [], 1: []}
    for i, (label, text) in enumerate(rows):
        if i % 5 != 4:
            seen[label].append(text.encode("utf-8", "surrogatepass"))
    trained = [_dictionary(seen[label], sample_bytes) for label in (1, 0)]
    if not all(trained):
        return QualityModel(b"", b"", (), prior)
    sizes = Sizes(*trained)
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    x = np.array([(1.0, *sizes.features(t)) for _, t in held])
    y = np.array([label for label, _ in held], float)
    return QualityModel(*trained, tuple(_logistic(x, y)), prior)


def _dictionary(texts: list[bytes], most: int) -> bytes:
    blocks = []
    for t in texts:
        blocks += [t[i:i + BLOCK] for i in range(0, len(t), BLOCK)]
        most -= len(t)
        if most < 0:
            break
    if sum(map(len, blocks)) < 1024 or len(blocks) < 16:
        return b"".join(blocks)
    size = min(DICTIONARY, sum(map(len, blocks)) // 8)
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:  # too uniform to train on: the raw text serves as the dictionary
        return b"".join(blocks)[:size]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton's method with a ridge on standardised inputs, returned for the inputs as they are."""
    mean, scale = x.mean(0), x.std(0)
    mean[0], scale[scale == 0] = 0.0, 1.0
    scale[0] = 1.0
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(hess, z.T @ (p - y) + ridge * len(y) * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    out = w / scale
    out[0] = w[0] - (w[1:] * mean[1:] / scale[1:]).sum()
    return out


def train_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
                  per_class: int = 2000, max_chars: int = 50_000) -> QualityModel:
    """Fit on at most ``per_class`` labelled texts of either class.

    A label counts if it is 0 or 1 and crc32 of the id's text modulo 5 is not 0; a document with
    contradicting labels has none.
    """
    kept = (labels.select(F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(label)).alias("label"))
            .where(F.col("label").isin(0, 1) & (crc_bucket(F.col("doc_id"), 5) != 0))
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
            .where("label = other").select("doc_id", "label"))
    chosen = None
    for value in (0, 1):
        top = kept.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = top if chosen is None else chosen.unionByName(top)
    labelled = keyed(docs, id_column, text).join(F.broadcast(chosen), "doc_id")
    return fit_quality(sampled_texts(labelled, "label", per_class, 2 * per_class, "doc_id", "text", max_chars))


class Scorer:
    def __init__(self, model: QualityModel):
        self.model = model
        self.sizes = Sizes(model.good, model.bad) if model.weights else None

    def score(self, text: str | None) -> float:
        if self.sizes is None:
            return self.model.prior
        z = float(np.dot(self.model.weights, (1.0, *self.sizes.features(text))))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def score_quality(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, score``."""
    def score(batches):
        scorer = Scorer(model)
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield i, scorer.score(t)

    rows = keyed(docs, id_column, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, score, "doc_id long, score double", doc_id=pa.int64(), score=pa.float64())


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The documents that score ``threshold`` or more, with all their columns."""
    def judge(batches):
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) >= threshold for t in batch.column(0).field(place).to_pylist()], pa.bool_()))

    place, rows = docs.columns.index(text), packed_rows(docs)
    return unpacked_rows(rows.mapInArrow(judge, rows.schema), docs.columns)
