"""Connected components of an edge table, by alternating star contraction.

Each round hangs the larger neighbours of a node on its smallest neighbour
(large star) and then the smaller ones (small star) until every component is
one star around its smallest node. A hub with very many edges is safe: minima
are combined inside each task before they move, and the joins that hand them
back can be split. Rounds are stored in the shared folder, so lineage stays
short and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.runtime import materialize

MAX_ROUNDS = 60


def _hang(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """Every neighbour ``v`` of ``u`` that is not the smallest goes below the smallest."""
    return (
        edges.join(smallest.withColumnRenamed("u", "hub"), F.col("u") == F.col("hub"))
        .filter(F.col("v") != F.col("low"))
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
    )


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    large = (
        both.filter(F.col("v") > F.col("u"))
        .join(low.withColumnRenamed("u", "hub"), F.col("u") == F.col("hub"))
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .distinct()
    )
    lowest = large.groupBy("u").agg(F.min("v").alias("low"))
    return (
        _hang(large, lowest)
        .unionByName(lowest.select("u", F.col("low").alias("v")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    # The hash sum is taken over 32-bit parts, so that it cannot overflow.
    part = F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 32) - 1))
    return tuple(edges.agg(F.count("*"), F.sum(part)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component: its smallest node.

    Edges may repeat, run either way and hold loops, which name their node.
    """
    ends = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stored = materialize(edges.select(*ends).distinct(), "edges")
    links = stored.filter("u != v")
    before = None
    for _ in range(MAX_ROUNDS):
        now = _state(links)
        if now == before or now[0] == 0:
            break
        before = now
        links = materialize(_round(links), "stars")
    else:
        raise RuntimeError(f"components still changed after {MAX_ROUNDS} rounds")
    alone = stored.select(F.col("v").alias("node")).unionByName(stored.select(F.col("u").alias("node"))).distinct()
    stars = links.select(F.col("u").alias("star_node"), F.col("v").alias("component"))
    return alone.join(stars, F.col("node") == F.col("star_node"), "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
