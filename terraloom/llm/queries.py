"""Registered queries of the operators, over the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import ann, bytebpe, exact, langid, lexical, lines, packing, pages, quality, repair, simhash, vectorfit, whitening
from terraloom.llm.common import crc_bucket, quoted
from terraloom.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_packing")
def op1(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op2_exact_dedup", """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))""")
def op2(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op3_compression_quality")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op4_simhash")
def op4(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_repair_token_files")
def op5(spark, sf_dir):
    out = shared_path(spark, "token-files")
    repair.write_token_files(table(spark, sf_dir, "documents"), out)
    return repair.read_token_files(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op6_fuzzy_lines")
def op6(spark, sf_dir):
    return lines.line_groups(table(spark, sf_dir, "documents"), wide=True)


@query("op7_projection_forest")
def op7(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op8_html_main_text")
def op8(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op9_byte_bpe")
def op9(spark, sf_dir):
    return bytebpe.encode(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_language_id")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify_languages(docs, language_model(docs)).select(
        "doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op11_lexical_search", r"""
with d as (select doc_id, row_number() over () as r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents where text is not null),
s as (select cast(count(*) as bigint) as docs, cast(sum(len(t)) as bigint) as terms from d where len(t) > 0),
p as (select r, term, cast(count(*) as bigint) as tf from (select r, unnest(t) as term from d) group by r, term),
f as (select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w from p, s group by term),
m as (select doc_id, r, 100 - 25 + (25 * len(t) * docs) // terms as m from d, s where len(t) > 0),
i as (select item_id, term, cast(count(*) as bigint) as c from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select distinct item_id, text from benchmark)) group by item_id, term),
scored as (select item_id, doc_id, r, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
  from i join f using (term) join p using (term) join m using (r) group by item_id, doc_id, r),
ranked as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20""")
def op11(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_vector_best_fit")
def op12(spark, sf_dir):
    return vectorfit.pack_best_fit(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Learned only from documents whose crc32 of the id's text modulo 4 is not 2."""
    return langid.train_languages(docs.where(crc_bucket(F.col(quoted("doc_id")), 4) != 2))
