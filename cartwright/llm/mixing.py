"""Mixing sources to target weights by repetition and hash-seeded draws.

Word counts are summed per source, each source gets its target and so a
repetition rate, and every document is taken floor(rate) times plus one
Bernoulli copy whose probability is the fraction. A draw depends on the seed
and the document's id alone: reruns and retried tasks agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.text import packed, uniform, whole, word_count
from cartwright.runtime import materialize


def source_targets(
    sizes: DataFrame, *, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """Per source: ``source_size``, ``target`` and ``rate``.

    Sources in order of code points, null last, weigh ``weights``, repeating.
    They share ``share`` times all sizes by weight; a target stops at ``most``
    times its source's size and the excess goes to the others by weight until
    none is above. That fixed point is min(cap, weight * level), where the
    level is the largest (budget - caps of the first k) / (weights of the
    rest) over sources ordered by cap per weight. Sources without words get 0.

    The windows run over one row per source, summed before.
    """
    unit = math.lcm(*weights)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (place + 1).cast("int"))
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    per_source = per_source.withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy(
        F.expr(f"cap * ({unit} div weight)"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(fill), F.lit(0))
    left = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(fill), F.lit(0))
    budget = F.lit(float(share)) * F.sum("source_size").over(everyone)
    level = F.max("step").over(everyone)
    return (
        per_source.withColumn("step", (budget - capped) / left)
        .withColumn("level", level)
        .select(
            "source",
            "source_size",
            F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"),
        )
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    )


def _copies(rate: Column, key: Column, seed: int) -> Column:
    whole_part = F.floor(rate)
    return whole_part + (uniform(key, seed) < rate - whole_part).cast("long")


def mix_counts(docs: DataFrame, *, seed: int = 0, **mix) -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, copies.

    Only ids, sources and sizes move; a source with a third of all rows is
    summed before it moves, and the join with the targets may be split.
    Rows that repeat an id are drawn alike.
    """
    sizes = docs.select("doc_id", "source", word_count(whole()).alias("size"))
    targets = source_targets(sizes, **mix).withColumnRenamed("source", "target_source")
    joined = sizes.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
    copies = _copies(F.col("rate"), F.col("doc_id"), seed)
    return joined.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mix_documents(docs: DataFrame, *, seed: int = 0, **mix) -> DataFrame:
    """The mixed corpus: each row of ``docs`` repeated as often as it is taken.

    The targets (one row per source) are stored first, so Spark knows their
    size when it chooses the join: the texts stay where they are unless there
    are very many sources.
    """
    sizes = docs.select("source", word_count(whole()).alias("size"))
    targets = materialize(source_targets(sizes, **mix).select(F.col("source").alias("target_source"), "rate"), "targets")
    rows = docs.select(packed(docs).alias("row"))
    copies = _copies(F.col("rate"), F.col("row.doc_id"), seed)
    taken = rows.join(targets, F.col("row.source").eqNullSafe(F.col("target_source"))).select(
        "row", copies.cast("int").alias("copies")
    )
    return taken.filter("copies > 0").select(
        F.explode(F.array_repeat("row", F.col("copies"))).alias("row")
    ).select("row.*")
