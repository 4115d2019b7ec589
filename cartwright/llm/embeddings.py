"""Embedding near-duplicates by p-stable hashing.

Vectors are scaled to length one and hashed by quantised random projections,
floor((a . v + b) / width), ``projections`` of them to a bucket, in ``tables``
tables. Vectors of one label that share a bucket are compared by exact cosine
in double precision.

Work stays linear in what a task holds: copies of one vector are one row with
a count; buckets of one member are dropped before any vector moves; a bucket
is cut into blocks, and a task compares two blocks at a time and sends on one
row per vector, not one per pair. A pair that shares several buckets counts in
the first table where it does.

Recall: two unit vectors at cosine 0.93 share a table's bucket with probability
0.851 ** 16 = 0.075 at width 2 and so at least one of 96 with 0.9994; at cosine
0.95 with 0.99999. Unrelated vectors share one with 0.486 ** 16 = 0.00001, so a
bucket holds about one stranger for each 100,000 vectors of a label; far larger
labels ask for more projections and tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.graph import connected_components
from cartwright.runtime import materialize

TABLES = 96
PROJECTIONS = 16
WIDTH = 2.0
SEED = 11
#: Members of a block; a task compares at most two blocks at a time.
BLOCK = 512


def _valid(vector: str = "embedding"):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(label, embedding, vec_id, copies, id): equal vectors of a label as one row, with its smallest vec_id.

    ``id`` numbers the rows; the result must be stored before it is used, so
    that the numbers stay.
    """
    usable = vectors.filter(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & _valid())
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    return classes.withColumn("id", F.monotonically_increasing_id())


def bucket_signatures(reps: DataFrame, *, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """``reps`` with ``buckets``: the bucket's number in each table, a 32-bit hash."""
    fields = list(reps.schema.fields) + [T.StructField("buckets", T.ArrayType(T.IntegerType()))]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            sizes, unit = _unit_rows(batch.column("embedding"))
            buckets = np.zeros((len(sizes), tables), np.int32)
            for n in np.unique(sizes):
                if n not in drawn:
                    rng = np.random.default_rng([seed, n])
                    drawn[n] = (
                        rng.standard_normal((n, tables * projections)),
                        rng.uniform(0, width, tables * projections),
                        rng.integers(1, 1 << 62, projections, dtype=np.uint64) * 2 + 1,
                    )
                direction, shift, mix = drawn[n]
                at = np.flatnonzero(sizes == n)
                steps = np.floor((unit[at, :n] @ direction + shift) / width).astype(np.int64).astype(np.uint64)
                hashed = (steps.reshape(len(at), tables, projections) * mix).sum(axis=2, dtype=np.uint64)
                buckets[at] = (hashed >> np.uint64(32)).astype(np.uint32).view(np.int32)
            signed = pa.ListArray.from_arrays(
                np.arange(0, buckets.size + 1, tables, dtype=np.int32), pa.array(buckets.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, signed], [f.name for f in fields])

    return reps.mapInArrow(sign, T.StructType(fields))


def _unit_rows(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the vectors, and the vectors scaled to length one, padded with zeros."""
    sizes = np.diff(np.asarray(vectors.offsets))
    rows = np.zeros((len(sizes), max(sizes, default=0)))
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = np.asarray(vectors.flatten(), dtype=np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return sizes, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _roots(pairs_x: np.ndarray, pairs_y: np.ndarray) -> dict[int, int]:
    """Smallest member of each component of these pairs."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(pairs_x.tolist(), pairs_y.tolist()):
        a, b = find(x), find(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


class _Members:
    """Rows of a sorted partition, one group after another."""

    def __init__(self, batch: pa.RecordBatch, tables: int):
        column = lambda name: np.asarray(batch.column(name))
        self.table, self.bucket, self.one, self.two = (column(c) for c in ("t", "bucket", "one", "two"))
        self.block, self.id, self.copies = (column(c) for c in ("block", "id", "copies"))
        self.sizes, self.unit = _unit_rows(batch.column("embedding"))
        self.signature = np.asarray(batch.column("buckets").flatten()).reshape(-1, tables)

    def starts(self) -> np.ndarray:
        change = np.zeros(len(self.id), bool)
        change[:1] = True
        for c in (self.table, self.bucket, self.one, self.two):
            change[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(change)


def _links_in(m: _Members, at: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the linked pairs of one group that no earlier table has compared."""
    t, one, two = m.table[at.start], m.one[at.start], m.two[at.start]
    rows = np.arange(at.start, at.stop)
    left, right = (rows, rows) if one == two else (rows[m.block[at] == one], rows[m.block[at] == two])
    close = m.unit[left] @ m.unit[right].T >= threshold
    close &= m.sizes[left][:, None] == m.sizes[right]
    if one == two:
        close = np.triu(close, 1)
    a, b = np.nonzero(close)
    a, b = left[a], right[b]
    if not len(a):
        return a, b
    seen = (m.signature[a, :t] == m.signature[b, :t]).any(axis=1)
    return a[~seen], b[~seen]


def embedding_links(
    reps: DataFrame, *, threshold: float, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH,
    seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """(id, links, root) per compared vector and group: links counts copies; id and root are in one component.

    Sum ``links`` by id for a vector's links to other distinct vectors. ``reps``
    is read twice.
    """
    signed = bucket_signatures(reps, tables=tables, projections=projections, width=width, seed=seed)
    signed = materialize(signed, "signatures")
    entries = signed.select("label", "id", F.posexplode("buckets").alias("t", "bucket"))
    shared = (
        entries.groupBy("label", "t", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
        .select("label", "t", "bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    members = entries.join(shared, ["label", "t", "bucket"]).select(
        "label", "t", "bucket", "id", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    )
    # Every pair of blocks, a block with itself included, is a group of its own.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    meetings = members.select("*", other.alias("other")).select(
        "id", "t", F.xxhash64("label", "bucket").alias("bucket"), "block",
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
    )
    keys = ["t", "bucket", "one", "two"]
    groups = (
        meetings.join(signed.select("id", "copies", "embedding", "buckets"), "id")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .select(*keys, "block", "id", "copies", "embedding", "buckets")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(batch: pa.RecordBatch, last: bool) -> tuple[pa.RecordBatch | None, pa.RecordBatch]:
            """Links of all complete groups, and the rows of the group that may go on."""
            m = _Members(batch, tables)
            starts = m.starts()
            ends = [*starts[1:], len(m.id)]
            whole = list(zip(starts, ends)) if last else list(zip(starts, ends))[:-1]
            found = [_links_in(m, slice(a, b), threshold) for a, b in whole if b - a > 1]
            a, b = (np.concatenate([f[i] for f in found] or [np.empty(0, np.int64)]) for i in (0, 1))
            rest = batch.slice(starts[-1]) if len(starts) and not last else batch.slice(0, 0)
            if not len(a):
                return None, rest
            links = np.zeros(len(m.id), np.int64)
            np.add.at(links, a, m.copies[b])
            np.add.at(links, b, m.copies[a])
            ids, inverse = np.unique(m.id, return_inverse=True)
            total = np.zeros(len(ids), np.int64)
            np.add.at(total, inverse, links)
            ids, total = ids[total > 0], total[total > 0]
            roots = _roots(m.id[a], m.id[b])
            return pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(total), pa.array([roots[i] for i in ids.tolist()], pa.int64())],
                ["id", "links", "root"],
            ), rest

        rest = None
        for batch in batches:
            if rest is not None and rest.num_rows:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            out, rest = linked(batch, last=False)
            if out is not None:
                yield out
        if rest is not None and rest.num_rows:
            out, _ = linked(rest, last=True)
            if out is not None:
                yield out

    return groups.mapInArrow(compare, "id long, links long, root long")


def _same_id(members: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of different vectors that one vec_id has."""
    first = members.groupBy("vec_id").agg(F.min("id").alias("a"), F.max("id").alias("last")).filter("a < last")
    return members.join(first, "vec_id").filter("id > a").select("a", F.col("id").alias("b")).distinct()


def near_duplicate_vectors(vectors: DataFrame, *, threshold: float = 0.93, **index) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors link if their labels are equal and not null, they have as many
    components, and their cosine is at least ``threshold``. Vectors that are
    null, empty, all zero or hold null or non-finite components, and rows with
    a null id, link with nothing. ``n_links`` counts every other linked row,
    copies included; ``component_id`` is the smallest id reachable by links.
    A row is kept if it has that id.

    Rows may repeat an id, with the same vector or another: each row counts
    its own vector's links, and as an id is one document, all its rows are in
    one component, whatever their labels.
    """
    reps = materialize(distinct_vectors(vectors), "distinct-vectors")
    found = materialize(embedding_links(reps, threshold=threshold, **index), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    # Every usable row meets its class by label and vector; the others by nothing. Vectors move no further.
    usable = F.col("vec_id").isNotNull() & _valid()
    rows = vectors.select("vec_id", "label", F.when(usable, F.col("embedding")).alias("embedding"))
    classes = reps.select(
        "id", F.col("label").alias("class_label"), F.col("embedding").alias("class_embedding"), "copies"
    )
    same = (F.col("label") == F.col("class_label")) & (F.col("embedding") == F.col("class_embedding"))
    members = materialize(rows.join(classes, same, "left").select("vec_id", "id", "copies"), "members")
    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b"))
    groups = connected_components(edges.unionByName(_same_id(members.filter("id IS NOT NULL"))))
    placed = reps.select("id", "vec_id").join(groups, F.col("id") == F.col("node"), "left")
    placed = materialize(placed.select("id", "vec_id", F.coalesce("component", "id").alias("component")), "groups")
    smallest = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    answers = (
        placed.join(smallest, "component").select("id", "component_id").join(links, "id", "left")
        .select(F.col("id").alias("class_id"), "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    )
    joined = members.join(answers, F.col("id") == F.col("class_id"), "left")
    component = F.coalesce("component_id", "vec_id")
    others = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return joined.select(
        "vec_id",
        others.cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
