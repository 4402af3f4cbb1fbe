"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florametrics.llm import (
    brown, hosttrust, html, lexical, linedup, merkle, mtree, neardup, packing, quality, suffixes, tiling, toxicity,
)
from florametrics.llm.common import fold, labelled_sample, lowered, table, texts
from florametrics.llm.oracles import HOSTS, MERKLE, SEARCH, URL_RULES
from florametrics.llm.registry import query

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", fold("doc_id", 3) != 1, 8000)
    found = toxicity.score(texts(docs), toxicity.fit(rows))
    return found.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", fold("doc_id", 5) != 0, 3000)
    found = quality.score(texts(docs), quality.fit(rows))
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op6_html_extraction")
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op4_mtree_top_k", """
WITH w AS (SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM w q JOIN w c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op4_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op1_brown_classes")
def op1_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = brown.score(docs, fold("doc_id", 5) != 1)
    return found.withColumn("held_out", fold("doc_id", 5) == 1)


@query("op7_odd_sketch_near_dedup")
def op7_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lost = linedup.removed_lines(docs)
    every = texts(docs).select("doc_id", F.size(F.split("text", "\n")).alias("n_lines"))
    return every.join(lost, "doc_id", "left").select(
        "doc_id", "n_lines", F.size(F.coalesce("removed", F.array().cast("array<int>"))).alias("n_removed"),
        F.array_sort("removed").alias("removed"))


@query("op8_string_tiling")
def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_repeated_bytes")
def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query("op11_merkle_manifest", MERKLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered(F.col("text")))


@query("op12_lexical_search", SEARCH)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_url_filters", HOSTS)
def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosttrust.verdicts(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")
