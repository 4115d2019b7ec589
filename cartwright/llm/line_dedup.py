"""Line deduplication with DataFrame functions only.

Explode normalised lines, hash them, count distinct documents per hash, drop
the lines of hashes over the threshold, reassemble by position.

What is shuffled: two hashes and an id per line (twice), the positions of
dropped lines, and each text once. A line found everywhere is spread over
tasks by (hash, document) while it is counted. The hashes over the threshold
are stored before they are joined: both sides of the join are then plain
shuffles, so adaptive execution can split the partition of such a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.text import SPACE, ascii_lower, lines_of, packed, whole
from cartwright.runtime import materialize


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row (id, text hash, position, two hashes of the key) per line that may be dropped."""
    key = line_key(F.col("line"))
    return (
        docs.select("doc_id", F.xxhash64(whole()).alias("text_hash"), F.posexplode(lines_of(whole())).alias("pos", "line"))
        .select("doc_id", "text_hash", "pos", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def drop_common_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop every line whose key occurs in at least ``min_docs`` documents.

    Returns ``row`` (a struct of all input columns), ``n_lines``, ``n_dropped``
    and ``kept_text``, one row per input row.

    A line's key is the line without outer white space, A-Z in lower case; keys
    are told apart by 128 hash bits. Keys shorter than ``min_chars`` code points
    (empty lines, by default) always stay. A null or empty text is one empty
    line. Documents are counted by ``doc_id``: rows that repeat an id count
    once (null ids count as one document), and each of them is answered from
    its own text. A document that loses all lines keeps the empty text.
    """
    source = docs.select("doc_id", "text")
    found_in = (
        _line_hashes(source, min_chars).select("doc_id", "h1", "h2").distinct()
        .groupBy("h1", "h2").agg(F.count("*").alias("n_docs"))
    )
    common = materialize(found_in.filter(F.col("n_docs") >= min_docs).select("h1", "h2"), "common-lines")
    dropped = (
        _line_hashes(source, min_chars)
        .join(common, ["h1", "h2"])
        .groupBy(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash"))
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )
    rows = docs.select(packed(docs).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    joined = rows.join(
        dropped,
        F.col("row.doc_id").eqNullSafe(F.col("dropped_id")) & (F.xxhash64(text) == F.col("dropped_hash")),
        "left",
    )
    # What lies between two neighbouring dropped lines stays: one slice for each gap, linear in the text.
    lines, gone = lines_of(text), F.coalesce(F.col("dropped"), F.array().cast("array<int>"))
    kept = F.flatten(
        F.zip_with(
            F.concat(F.array(F.lit(-1)), gone),
            F.concat(gone, F.array(F.size("lines"))),
            lambda before, after: F.slice(F.col("lines"), before + 2, after - before - 1),
        )
    )
    return joined.select("row", "dropped", lines.alias("lines")).select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce(F.col("row.text"), F.lit("")))
        .otherwise(F.array_join(kept, "\n"))
        .alias("kept_text"),
    )
