"""One query for each operator, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bwt, ctw, decontam, eodscan, jaccard, merkle, mixing, ordinal, redirects, simhash, spelling, toxicity
from .common import table

#: Folder of the public tokenizers' vocabulary files, on the driver.
TOKENIZERS = os.environ.get("TOKENIZERS", "/opt/tokenizers")
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.search(ann.build_index(vectors), vectors.where("vec_id % 100 = 0"), k=10)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    scored = ctw.score(docs.withColumn("learn", ~held_out))
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "n_bytes")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.build_index(table(spark, sf_dir, "documents", "doc_id", "text"))
    found = decontam.search(index, table(spark, sf_dir, "benchmark", "item_id", "text"), size=10, slack=12)
    n_hit = F.expr("cast(aggregate(spans, 0, (a, x) -> a + x.e - x.s) as bigint)")
    return found.select(F.col("id").cast("bigint").alias("doc_id"), F.col("n_words").cast("bigint").alias("n_words"),
                        n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    ratings = table(spark, sf_dir, "labels", "doc_id", "quality").withColumnRenamed("quality", "grade")
    graded = ordinal.score(docs, ordinal.train(docs, ratings))
    return graded.select("doc_id", "expected_grade", "tail_probability",
                         (F.col("tail_probability") >= 0.5).alias("selected"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.near_duplicates(docs).select("doc_id", "class_id", "n_links")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return eodscan.token_counts(docs, eodscan.byte_pair_encoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken"), eod=50256)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return redirects.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bwt.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                           F.sha2("kept", 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    labels = (table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out)
              .withColumnRenamed("toxic", "label"))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents", "doc_id", "text"), slip=199)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *merkle.FIELDS)
    tampered = merkle.tampered_leaf(when=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return merkle.prove(merkle.build(docs, changed=tampered)).withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_neighbours, op2_mixing, op3_lm_scoring, op4_decontamination, op5_quality, op6_jaccard, op7_token_counts,
                                      op8_url_filters, op9_repeated_passages, op10_toxicity, op11_simhash, op12_spelling, op13_manifest)}
