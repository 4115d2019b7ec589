"""Centroid clustering against plain Lloyd rounds in whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwright.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, components, k, rounds):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) rows of one vector after another."""
    kept = []
    for vec_id, vector, *_ in rows:
        if vector is not None and len(vector) == components and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector]))
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for i, vs in members.items():
            centroids[i] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    sha = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha(c)) for i, c, d in found), key=repr)


def run(frame, **how):
    return sorted(map(tuple, clusters.centroid_clusters(frame, **how).collect()), key=repr)


def _rows(n, components, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(i % 5, 0.4, components).astype(np.float32).tolist(), 1) for i in range(n)]


def test_equals_plain_rounds(spark):
    rows = _rows(150, 6)
    rows += [(200, None, 1), (201, [], 1), (202, [1.0] * 5, 1), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1)]
    rows += [(204, [math.nan] + [1.0] * 5, 1), (205, [math.inf] + [1.0] * 5, 1), (206, [0.0] * 6, None)]
    rows += [(207, [-0.001] * 6, 1), (None, [0.5] * 6, 1), (None, [0.25] * 6, 1), (3, [9.0] * 6, 1), (3, [9.0] * 6, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("cluster", "distance", "x", "h", "i")})
    for k, rounds in ((7, 5), (1, 2), (500, 1), (3, 0)):
        assert run(frame, components=6, k=k, rounds=rounds) == plain(rows, 6, k, rounds)
    assert run(frame.repartition(6), components=6, k=7) == run(frame.coalesce(1), components=6, k=7)


def test_equal_vectors_and_empty_clusters(spark):
    """Equal first centroids tie; the larger numbers stay empty and keep their place."""
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(30)] + [(40 + i, [1.0, 2.0, float(i)], 1) for i in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = run(frame, components=3, k=10, rounds=4)
    assert got == plain(rows, 3, 10, 4)
    assert {r[1] for r in got} < set(range(10))


def test_no_usable_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [1.0], 1)]):
        found = clusters.centroid_clusters(spark.createDataFrame(rows, SCHEMA), components=3)
        assert found.collect() == []
        assert [t for _, t in found.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_components_too_large_for_the_results(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0], 1), (2, [1.0, 0.0], 1)], SCHEMA)
    with pytest.raises(Exception, match="64 bits"):
        clusters.centroid_clusters(frame, components=2).collect()


numbers = st.integers(-(1 << 20), 1 << 20)


@settings(max_examples=120, deadline=None)
@given(st.data(), st.integers(1, 5))
def test_assignment_is_exact(data, width):
    vector = st.lists(numbers | st.integers(-2, 2), min_size=width, max_size=width)
    x = np.array(data.draw(st.lists(vector, min_size=1, max_size=25)), np.int64)
    centroids = np.array(data.draw(st.lists(vector, min_size=1, max_size=8)), np.int64)
    space = clusters.PivotSpace(clusters.choose_pivots(centroids, 4), 5)
    cluster, squared, _ = clusters.assign(x, space.distances(x), centroids, space)
    full = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert cluster.tolist() == full.argmin(axis=1).tolist() and squared.tolist() == full.min(axis=1).tolist()
    bounds = space.lower_bounds(space.distances(x), space.distances(centroids))
    assert (bounds**2 <= full + 1e-9 * full).all()


def test_bounds_spare_distances():
    rng = np.random.default_rng(0)
    middle = rng.integers(-5000, 5000, (40, 16))
    x = middle[rng.integers(0, 40, 4000)] + rng.integers(-60, 60, (4000, 16))
    space = clusters.PivotSpace(clusters.choose_pivots(middle))
    _, _, measured = clusters.assign(x, space.distances(x), middle, space)
    assert measured < 0.2 * 4000 * 40
