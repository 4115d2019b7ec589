"""SimHash, embedding near-duplicates and components against brute force."""

import math
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwright.llm import embeddings, simhash
from cartwright.llm.graph import connected_components
from cartwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBÄé \t\n\x0b\x1c\x85\u3000😀"), max_size=60))
def test_fingerprint(text):
    assert simhash.simhash_of(text) % (1 << 64) == plain_fingerprint(text)


def test_fingerprint_of_a_very_long_text():
    text = " ".join(random.Random(1).choices(["a", "b", "ccc", "Dd"], k=100_000))
    assert simhash.simhash_of(text) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("pair_cell", [128, 3])
def test_links_lose_nothing(spark, pair_cell):
    """Groups of fingerprints around centres, tied pair by pair and by common neighbours."""
    rng = random.Random(pair_cell)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            v = centre
            for _ in range(rng.randrange(0, 6)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    rows = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)]
    reps = spark.createDataFrame(rows, "fp long, id long")
    edges = simhash.simhash_links(reps, pair_cell=pair_cell)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    links = [
        (i, j) for j, b in enumerate(values) for i, a in enumerate(values[:j]) if bin(a ^ b).count("1") <= 2
    ]
    want = components(range(len(values)), links)
    assert {n: got.get(n, n) for n in want} == want
    if pair_cell == 128:
        assert {tuple(sorted((r.a, r.b))) for r in edges.collect()} == set(links)


def test_near_duplicate_documents(documents):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(8)]
    rows = [(i + 10, b, None, None) for i, b in enumerate(base)]
    rows += [(100 + i, base[i % 8].upper(), None, None) for i in range(20)]
    rows += [(200, None, None, None), (201, "", None, None), (202, " \n", None, None), (203, "a b", None, None)]
    rows += [(10, base[0], None, None), (None, base[1], None, None)]
    docs = documents(rows, clash=("fp", "id", "component_id", "node", "t", "key"))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[100 + i].component_id == i % 8 + 10 for i in range(20))
    assert {by_id[i].component_id for i in (200, 201, 202)} == {200} and by_id[200].fp == 0
    assert by_id[None].component_id is None and by_id[None].fp == by_id[11].fp


def test_no_documents(documents):
    assert simhash.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 9, 200])
def test_components_of_chains_hubs_and_loops(spark, n):
    chain = [(i, i + 1) for i in range(n)]
    hub = [(1000, 1000 + i) for i in range(n)]
    edges = [*chain, *hub, *hub, (5000, 5000)]
    random.Random(n).shuffle(edges)
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {x for e in edges for x in e}
    assert {r.node: r.component for r in got} == components(nodes, edges) and len(got) == len(nodes)


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- embeddings


def plain_vectors(rows, threshold=0.93):
    """n_links, component and kept of (vec_id, vector, label) rows, pair by pair."""

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)

    units = [None if label is None or i is None else unit(v) for i, v, label in rows]
    links = [
        (a, b)
        for b in range(len(rows))
        for a in range(b)
        if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
        and units[a] @ units[b] >= threshold
    ]
    found = components([i for i, *_ in rows if i is not None], [(rows[a][0], rows[b][0]) for a, b in links])
    n = [sum(k in pair for pair in links) for k in range(len(rows))]
    return sorted((i, n[k], found.get(i), i is not None and found[i] == i) for k, (i, *_) in enumerate(rows))


def _near(rng, vector, noise):
    return [float(x + rng.gauss(0, noise)) for x in vector]


def test_ids_with_several_vectors(spark):
    """Links are counted per row; all rows of an id are in one component, whatever vectors and labels they have."""
    rng = np.random.default_rng(4)
    v, far, other = (rng.normal(size=16).tolist() for _ in range(3))
    near = (np.array(v) + 0.01 * rng.normal(size=16)).tolist()
    schema = "vec_id long, embedding array<double>, label int"
    run = lambda rows: sorted(map(tuple, embeddings.near_duplicate_vectors(spark.createDataFrame(rows, schema)).collect()))
    assert run([(1, v, 0), (1, near, 0), (2, far, 0)]) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert run([(5, v, 0), (5, far, 0), (3, near, 0), (4, far, 0), (4, far, 0), (9, other, 1)]) == [
        (3, 1, 3, True), (4, 2, 3, False), (4, 2, 3, False), (5, 1, 3, False), (5, 2, 3, False), (9, 0, 9, True),
    ]
    assert run([(7, v, 0), (7, v, 1), (6, near, 1)]) == [(6, 1, 6, True), (7, 0, 6, False), (7, 1, 6, False)]


def test_embedding_links(spark):
    rng = random.Random(5)
    rows = []
    for label in (1, 2):
        for _ in range(8):
            centre = [rng.gauss(0, 1) for _ in range(64)]
            rows += [(_near(rng, centre, 0.12), label) for _ in range(14)]
            rows += [(centre, label)] * 3
    # Scaled copies, another label, no label, other lengths, and vectors that link with nothing.
    first = rows[0][0]
    rows += [([7 * x for x in first], 1), (first, 2), (first, None), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([2.0, -4.0], 1)]
    rows += [(None, 1), ([], 1), ([0.0] * 64, 1), ([0.0] * 64, 1), ([None] + first[1:], 1), ([float("nan")] + first[1:], 1)]
    rows += [([float("inf")] + first[1:], 1), ([1e30] * 64, 2), ([1e-30] * 64, 2)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    rows = [(i, v, label) for i, (v, label) in zip(ids, rows)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("x") for c in ("id", "copies", "buckets", "t", "bucket", "links", "node")}
    )
    want = plain_vectors(rows)
    # Small blocks: large buckets are compared block against block.
    for block in (512, 5):
        got = sorted(map(tuple, embeddings.near_duplicate_vectors(table, block=block).collect()))
        assert got == want


def test_embedding_recall_at_the_threshold(spark):
    """Pairs at cosine 0.93 to 0.94, the hardest to find: at least nine of ten are."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = rng.uniform(0.9305, 0.94)
        rows += [(2 * k, a.tolist(), 1), (2 * k + 1, (cosine * a + math.sqrt(1 - cosine**2) * b).tolist(), 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embeddings.near_duplicate_vectors(table).filter("n_links > 0").count()
    assert found >= 0.9 * len(rows)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicate_vectors(empty).count() == 0
    (row,) = embeddings.near_duplicate_vectors(spark.createDataFrame([(None, [1.0], 1)], empty.schema)).collect()
    assert tuple(row) == (None, 0, None, False)


def test_queries_over_the_test_tables(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    got = sorted(map(tuple, QUERIES["op1_embedding_near_dedup"](spark, SF).collect()))
    assert got == plain_vectors([tuple(v) for v in vectors])
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if bin(fps[a] ^ fps[b]).count("1") <= 2]
    want = components(ids, links)
    for r in QUERIES["op3_simhash_near_dedup"](spark, SF).collect():
        assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", want[r.doc_id])


def test_embedding_tables_miss_few_pairs_at_the_threshold(spark):
    """Of pairs at cosine 0.93 exactly, nearly all share a bucket under the production parameters."""
    rng = np.random.default_rng(7)
    n, size = 4000, 64
    a = rng.standard_normal((n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((n, size))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.93 * a + (1 - 0.93**2) ** 0.5 * b / np.linalg.norm(b, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate([*a, *b])]
    signed = embeddings.bucket_signatures(
        spark.createDataFrame(rows, "id long, embedding array<double>"), tables=embeddings.TABLES,
        projections=embeddings.PROJECTIONS, width=embeddings.WIDTH, seed=embeddings.SEED,
    )
    buckets = np.array([r.buckets for r in signed.orderBy("id").collect()])
    assert (buckets[:n] == buckets[n:]).any(axis=1).mean() > 0.997
