"""From raw documents to packed training sequences, in five stages.

Every stage works on all that its predecessor kept; its result is written as
Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import language, line_dedup, mixing, packing, simhash
from cartwright.llm.shipping import ship_package
from cartwright.llm.text import packed, table, unpacked
from cartwright.runtime import delete, fresh_path, materialize, small_batches, temporary_tables

#: Packing and language vectors have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language that these documents teach, and put wrong labels right.

    The prototypes are learnt from all labelled documents. Texts without a
    letter, and texts unlike those of any language for their length, go.
    ``lang`` becomes the predicted language where there is no label of a learnt
    language, or the text is clearly in another one. If there is nothing to
    learn from, a document goes only if it has no letter.
    """
    ship_package(spark)
    prototypes = language.train_prototypes(docs)
    if not prototypes:
        return docs.filter(F.coalesce("text", F.lit("")).rlike(r"\p{L}"))
    with small_batches(spark):
        found = materialize(language.identify(docs, prototypes), "identified")
    judged = language.judge_labels(found, list(prototypes)).filter(~F.col("foreign"))
    label = F.when(F.col("relabelled"), F.col("lang_pred")).otherwise(F.col("row.lang"))
    return unpacked(judged, "row", {"lang": label})


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more share; ``n_chars`` follows the text."""
    kept = line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return unpacked(kept, "row", {c: v for c, v in changed.items() if c in docs.columns})


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group; rows without an id stay.

    Rows that repeat the id of a kept document stay as well: they are that document.
    """
    ship_package(spark)
    groups = simhash.near_duplicates(docs, shingle=3)
    gone = groups.filter("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    rows = docs.select(packed(docs).alias("row"))
    return unpacked(rows.join(gone, F.col("row.doc_id") == F.col("gone_id"), "left_anti"), "row")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mix_documents(docs, weights=(3, 1, 2), share=1.5, most=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 1024 tokens."""
    ship_package(spark)
    with small_batches(spark):
        return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end=2)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. A stage's own tables go when its result is stored, and its result when the next one's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with temporary_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
