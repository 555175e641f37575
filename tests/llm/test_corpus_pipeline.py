"""The pipeline and the registered queries on the small tables."""

import os

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from terraloom.llm import exact, langid, quality, queries, simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def test_stages_apply_their_decisions_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "exact_dedup", "simhash_dedup", "packing"]
    model = queries.language_model(docs)
    named = corpus_pipeline.language_id(spark, docs, SF)
    rejected = {r.doc_id for r in langid.identify_languages(docs, model).where("rejected").collect()}
    assert named.columns == docs.columns and {r.doc_id for r in named.collect()} == {r.doc_id for r in docs.collect()} - rejected

    good = corpus_pipeline.quality_classifier(spark, docs, SF)
    scores = quality.score_quality(docs, quality.train_quality(docs, queries.table(spark, SF, "labels")))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores.where("score >= 0.3").collect()}

    once = corpus_pipeline.exact_dedup(spark, docs, SF)
    assert {r.doc_id for r in once.collect()} == {r.doc_id for r in exact.exact_groups(docs).where("kept").collect()}

    apart = corpus_pipeline.simhash_dedup(spark, docs, SF)
    assert {r.doc_id for r in apart.collect()} == {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert apart.columns == docs.columns and apart.count() == apart.select("doc_id").distinct().count()


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert whole.where("n <> t").count() == 0


def test_every_operator_is_registered_and_sql_agrees(spark):
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{k}" for k in range(1, 11)}
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    for name, sql in queries.SQL.items():
        want = db.execute(sql)
        columns = [d[0] for d in want.description]
        assert sorted(map(tuple, names[name](spark, SF).select(*columns).collect())) == sorted(want.fetchall())


def test_language_and_quality_on_held_out_rows(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    said = entry.queries()["op10_language_id"](spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null")
    assert said.where("lang_pred = lang").count() >= 0.95 * said.count()
    judged = entry.queries()["op3_compression_quality"](spark, SF).where("held_out").join(labels, "doc_id")
    assert judged.where("predicted = quality").count() >= 0.85 * judged.count()
