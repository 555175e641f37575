"""Language identification and quality by compression."""

import random

import numpy as np
import pytest
from llm.helpers import EDGES, documents, prose
from pyspark.sql import functions as F

from terraloom.llm import langid, quality

SYLLABLES = {"aa": "ba ko ti ru ".split(), "bb": "zhe schi wum ol".split(), "cc": "éa ñu íl ço".split()}


def invented(lang, seed, words=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def language_docs(spark):
    rows = [(i, invented(lang, i, 1 + i % 60), lang) for i, lang in enumerate(list(SYLLABLES) * 120)]
    return spark.createDataFrame(rows + [(9001, None, "aa"), (9002, "12 34 !", "bb"), (9003, invented("aa", -1), None)], "doc_id long, text string, lang string")


def test_languages_are_told_apart_on_held_out_rows(language_docs):
    model = langid.train_languages(language_docs.where("doc_id % 3 <> 0 or doc_id % 2 = 0"), per_language=60)
    assert model.languages == ("aa", "bb", "cc")
    got = langid.identify_languages(language_docs, model).join(language_docs.select("doc_id", "lang"), "doc_id").where("doc_id < 9000").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.rejected for r in got]) < 0.02
    kept = langid.keep_identified(language_docs, model)
    assert kept.columns == language_docs.columns and kept.where("doc_id in (9001, 9002)").count() == 0


def test_language_edges(spark, language_docs):
    model = langid.train_languages(language_docs, per_language=40)
    docs = documents(spark, EDGES + [(20, "!!! 123"), (21, "²³"), (22, "é")])
    got = langid.identify_languages(docs, model).collect()
    assert len(got) == len(EDGES) + 3
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 5, 20, 21} and all(r.rejected for r in got if r.lang_pred == "und")
    assert langid.identify_languages(documents(spark, []), model).collect() == []
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns


def test_language_model_without_labels(spark):
    docs = documents(spark, EDGES).withColumn("lang", F.lit(None).cast("string"))
    model = langid.train_languages(docs)
    assert {(r.lang_pred, r.score) for r in langid.identify_languages(docs, model).collect()} == {("und", 0.0)}


def test_long_texts_are_featurised_whole(monkeypatch):
    letter, text = langid.letters(), invented("bb", 5, 300) + " 12.. " + invented("aa", 6, 10)
    table = np.random.default_rng(1).normal(size=(langid.BUCKETS, 2)).astype(np.float32)
    whole = langid._sums([text, "ba", ""], table, letter)
    monkeypatch.setattr(langid, "_PIECE", 37)
    pieces = langid._sums([text, "ba", ""], table, letter)
    assert np.allclose(whole[0], pieces[0], atol=1e-3) and whole[1].tolist() == pieces[1].tolist()


def test_subwords_are_ngrams_of_words_with_boundaries():
    letter = langid.letters()
    (_, gram, bounds), = langid.subwords(["ab c"], letter)
    # " ab " has _a ab b_, _ab ab_, _ab_; " c " has _c c_, _c_
    assert bounds.tolist() == [0, 9] and len(set(gram.tolist())) == 9


def test_languages_sample_is_bounded(language_docs):
    rows = langid.sampled_texts(language_docs, "lang", 10, 25, "doc_id", "text", 20_000)
    assert len(rows) == 25 and all(t for _, t in rows)
    assert rows == langid.sampled_texts(language_docs, "lang", 10, 25, "doc_id", "text", 20_000)


def bad(seed, words):
    rng = random.Random(seed)
    return " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in prose(seed, words).split())


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, prose(i, 20 + i % 90) if i % 4 else bad(i, 20 + i % 90), 1 if i % 4 else 0) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(5, None), (7000, 1), (8, 1), (None, 0)], "doc_id long, quality int")
    return docs, labels, {i: q for i, _, q in rows}


def test_quality_tells_good_from_bad_on_held_out_rows(judged):
    docs, labels, truth = judged
    model = quality.train_quality(docs, labels, per_class=150)
    got = quality.score_quality(docs, model).collect()
    assert len(got) == 600 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= 0.3) == bool(truth[r.doc_id]) for r in got]) > 0.97
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.3 for r in got)


def test_quality_learns_only_from_its_rows(judged, spark):
    docs, labels, _ = judged
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train_quality(docs, labels) == quality.train_quality(docs, flipped)


def test_quality_edges(spark, judged):
    docs, labels, _ = judged
    model = quality.train_quality(docs, labels, per_class=100)
    odd = documents(spark, EDGES)
    got = quality.score_quality(odd, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.score_quality(documents(spark, []), model).collect() == []
    one_sided = quality.train_quality(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.score_quality(odd, one_sided).collect()} == {1.0}
    none = quality.train_quality(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(odd, none).collect()} == {0.5}
