"""One registered query per operator, with its production parameters, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cartwright.llm import (
    clusters,
    divergence,
    embeddings,
    language,
    licenses,
    line_dedup,
    mixing,
    packing,
    quality,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)
from cartwright.llm.oracle import ORACLE
from cartwright.llm.shipping import ship_package
from cartwright.llm.text import table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end=2)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3)
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a directory, a language one below it, a document a file."""
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text"
    )
    return licenses.scan_licenses(files).withColumnRenamed("file_id", "doc_id")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_counts(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.held_out()
    training = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic")
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), training)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = language.train_prototypes(docs.filter(~language.held_out(F.col("doc_id"))))
    return language.identify(docs, prototypes).select(
        "row.doc_id", language.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rules_frame(spark, URL_RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.centroid_clusters(table(spark, sf_dir, "embeddings"), components=64, k=40, rounds=5, seed=2, scale=256)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), limit=1024)
    return counted.select("row.doc_id", "n_bytes", "n_tokens", "over_limit")


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_embedding_near_dedup, op2_best_fit_packing, op3_simhash_near_dedup, op4_license_scan, op5_mix_sources,
        op6_toxicity, op7_language_id, op8_line_dedup, op9_url_filter, op10_quality_rules,
        op11_source_divergence, op12_centroid_clusters, op13_token_counts,
    )
} | {"pipeline": corpus_pipeline.run}

__all__ = ["ORACLE", "QUERIES"]
