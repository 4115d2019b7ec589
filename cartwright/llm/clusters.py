"""Centroid clustering of whole-number vectors, with Ptolemaic pivot bounds.

Lloyd's rounds: every vector goes to its nearest centroid, every centroid to
the floor of its vectors' mean. Distances to a few fixed pivots are computed
once per vector and stored. Ptolemy's inequality holds for any four points of
a Euclidean space: for pivots p and s

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s),

so a round needs the pivot distances of the centroids alone to bound all
distances from below. Bounds are rounded down by more than their floating
error; the centroid of the least bound is measured first, and only those whose
bound does not exceed that distance are measured as well. What is measured is
exact, in 64-bit whole numbers.

Centroids (at most ``k`` of them) and their sums pass through the driver, the
vectors never do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.runtime import materialize

CENTROIDS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
PIVOTS = 16
#: Fixed pivot pairs that bound a distance.
PIVOT_PAIRS = 40
#: Components up to this size have squared distances, and sums of them per task, that 64 bits hold.
LARGEST = 1 << 24
_CHUNK = 1 << 15
#: More than the relative error of a bound's few floating operations.
_MARGIN = 1e-13


def quantised(vectors: DataFrame, components: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the usable ``vectors``: floor(scale * component) for each component, as bigint."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.filter((F.size("embedding") == components) & F.coalesce(finite, F.lit(False)))
    return usable.select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale)).cast("long")).alias("x")
    )


def starting_order(vec_id: Column, seed: int = SEED) -> Column:
    """The hexadecimal digest by which vectors are drawn as first centroids; a null id counts as an empty one."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def first_centroids(points: DataFrame, k: int, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors of the smallest digests, in their order; equal ids by their components."""
    drawn = points.select(starting_order(F.col("vec_id"), seed).alias("h"), "x").orderBy("h", "x").limit(k)
    return np.array([r["x"] for r in drawn.collect()], np.int64)


def choose_pivots(candidates: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Up to ``n`` different vectors far from each other, the first candidate among them."""
    chosen, nearest = [0], _squared(candidates, candidates[0])
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _squared(candidates, candidates[chosen[-1]]))
    return candidates[chosen]


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    difference = x - y
    return np.einsum("...i,...i->...", difference, difference)


class PivotSpace:
    """Fixed pivots and the pairs of them, the widest ones, that bounds are taken from."""

    def __init__(self, pivots: np.ndarray, pairs: int = PIVOT_PAIRS):
        self.pivots = pivots
        apart = {(i, j): float(np.sqrt(_squared(pivots[i], pivots[j]))) for i, j in combinations(range(len(pivots)), 2)}
        self.pairs = sorted(apart.items(), key=lambda p: -p[1])[:pairs]

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([_squared(x, p) for p in self.pivots], axis=1).astype(np.float64))

    def lower_bounds(self, x_to: np.ndarray, c_to: np.ndarray) -> np.ndarray:
        """Bounds of the distances between points and centroids, from their distances to the pivots."""
        best = np.zeros((len(x_to), len(c_to)))
        for (i, j), apart in self.pairs:
            one, two = np.outer(x_to[:, i], c_to[:, j]), np.outer(x_to[:, j], c_to[:, i])
            np.maximum(best, (np.abs(one - two) - _MARGIN * (one + two)) / apart, out=best)
        return best * (1 - _MARGIN)


def assign(
    x: np.ndarray, x_to: np.ndarray, centroids: np.ndarray, space: PivotSpace
) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance) of each row of ``x``, ties to the smaller number; exact distances taken."""
    bounds = space.lower_bounds(x_to, space.distances(centroids))
    rows = np.arange(len(x))
    first = bounds.argmin(axis=1)
    known = np.full(bounds.shape, np.iinfo(np.int64).max)
    known[rows, first] = _squared(x, centroids[first])
    open_ = bounds * bounds * (1 - _MARGIN) <= known[rows, first][:, None]
    open_[rows, first] = False
    row, centroid = np.nonzero(open_)
    for at in range(0, len(row), _CHUNK):
        r, c = row[at : at + _CHUNK], centroid[at : at + _CHUNK]
        known[r, c] = _squared(x[r], centroids[c])
    cluster = known.argmin(axis=1)
    return cluster, known[rows, cluster], len(x) + len(row)


def _matrix(column: pa.ListArray, width: int, dtype) -> np.ndarray:
    return np.asarray(column.flatten()).astype(dtype, copy=False).reshape(len(column), width)


def with_pivot_distances(points: DataFrame, space: PivotSpace) -> DataFrame:
    """(vec_id, x, to_pivots). Fails on a component above ``LARGEST``."""
    width = space.pivots.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width, np.int64)
            if (np.abs(x) > LARGEST).any():
                raise ValueError(f"a scaled component is beyond {LARGEST}: squared distances would not fit 64 bits")
            far = space.distances(x)
            ends = np.arange(0, far.size + 1, far.shape[1], dtype=np.int32)
            columns = [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(far.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "to_pivots"])

    id_type = points.schema["vec_id"].dataType.simpleString()
    return points.mapInArrow(measure, f"vec_id {id_type}, x array<bigint>, to_pivots array<double>")


def cluster_sums(points: DataFrame, centroids: np.ndarray, space: PivotSpace) -> list[tuple[int, int, list[int]]]:
    """(cluster, vectors, component sums) of the clusters that have vectors; tasks send one row per cluster."""
    k, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), width, np.int64)
            cluster, _, _ = assign(x, _matrix(batch.column("to_pivots"), len(space.pivots), np.float64), centroids, space)
            count += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, x)
        seen = np.flatnonzero(count)
        ends = np.arange(0, len(seen) * width + 1, width, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(count[seen]), pa.ListArray.from_arrays(ends, pa.array(total[seen].ravel()))],
            ["cluster", "n", "total"],
        )

    # Sums of many tasks may pass 64 bits where those of one do not.
    wide = "decimal(38,0)"
    per_component = (
        points.mapInArrow(sums, "cluster int, n bigint, total array<bigint>")
        .select("cluster", "n", F.posexplode("total").alias("i", "part"))
        .groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast(wide)).alias("total"))
        .groupBy("cluster").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "total"))).alias("total"))
    )
    return [(r["cluster"], r["n"], [int(p["total"]) for p in r["total"]]) for r in per_component.collect()]


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def centroid_clusters(
    vectors: DataFrame, *, components: int = 64, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED,
    scale: int = SCALE, pivots: int = PIVOTS, pairs: int = PIVOT_PAIRS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every usable vector.

    Usable are vectors (vec_id, embedding) of exactly ``components`` finite
    components; all others, null ones included, have no row. ``distance`` is
    squared; inertias are its sums over the cluster and over all.

    Every row is a vector of its own, so rows may repeat an id, and a null id
    is drawn like an empty text. Equal distances go to the smaller cluster; a
    cluster without vectors keeps its centroid. Fewer usable vectors than
    ``k`` make as many clusters, none makes an empty result. Further columns
    are not read. A scaled component beyond ``LARGEST`` stops the job, as the
    results would not fit their 64-bit columns.
    """
    points = quantised(vectors, components, scale)
    centroids = first_centroids(points, k, seed)
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not len(centroids):
        empty = points.filter(F.lit(False))
        return empty.select(
            "vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in names[2:5]], F.lit("").alias(names[5])
        )
    if np.abs(centroids).max() > LARGEST:
        raise ValueError(f"a scaled component is beyond {LARGEST}: squared distances would not fit 64 bits")
    space = PivotSpace(choose_pivots(centroids, pivots), pairs)
    stored = materialize(with_pivot_distances(points, space), "pivot-distances")
    for _ in range(rounds):
        centroids = centroids.copy()
        for cluster, n, total in cluster_sums(stored, centroids, space):
            centroids[cluster] = [part // n for part in total]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), components, np.int64)
            cluster, squared, _ = assign(x, _matrix(batch.column("to_pivots"), len(space.pivots), np.float64), centroids, space)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(squared)], names[:3])

    id_type = stored.schema["vec_id"].dataType.simpleString()
    labelled = materialize(stored.mapInArrow(label, f"vec_id {id_type}, cluster int, distance bigint"), "clustered")
    per_cluster = labelled.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    inertia = {r["cluster"]: r["cluster_inertia"] for r in per_cluster}
    # One row per cluster, at most k.
    facts = labelled.sparkSession.createDataFrame(
        [(c, i, sum(inertia.values()), centroid_digest(centroids[c])) for c, i in sorted(inertia.items())],
        "of_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return labelled.join(F.broadcast(facts), F.col("cluster") == F.col("of_cluster")).select(*names)
