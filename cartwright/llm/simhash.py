"""SimHash near-duplicates, found with pivot distance tables.

A text's fingerprint has the majority bits of its shingles' hashes. The
Hamming distances of every distinct fingerprint to a set of reference
fingerprints (pivots) are computed once. Two fingerprints at distance r have
pivot distances that differ by at most r, so a pair with a larger difference in
any coordinate is discarded, and only the rest is compared bit by bit.

How pairs meet without comparing all: the 64 bits are cut into ``bands``, and
each band has its own pivots, whose bits lie in that band. Relative to the
distance to the zero pivot, their distances depend on the band alone. A pair
that differs in at most two bits differs in at most that many bands, so
for some choice of the other bands all their relative distances agree: an
equi-join on these coordinates loses no pair.

Cells with many fingerprints (versions of one boilerplate, say) would have a
quadratic number of pairs. They take an exact linear way instead: two
fingerprints of a cell differ by at most two bits if and only if they have a
common neighbour within one bit, and only bits of the free bands can differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.graph import connected_components
from cartwright.llm.text import whole
from cartwright.runtime import materialize, small_batches

#: Hash seed of the shingles; a fixed value of the fingerprint format.
SHINGLE_SEED = 42
#: Fingerprints link at this many differing bits or fewer. Common neighbours within one bit decide just this distance.
BITS = 2
BANDS = 5
PIVOTS_PER_BAND = 8
PIVOT_SEED = 20
#: A cell of up to this many fingerprints is joined pair by pair, a larger one by common neighbours.
PAIR_CELL = 128

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_HASHES_AT_ONCE = 1 << 15


def simhash_of(text: str, shingle: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1) - 1
        starts = np.concatenate(([0], stops[: len(words) - shingle] + 1)).tolist()
        ends = stops[shingle - 1 :].tolist()
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for i in range(0, len(starts), _HASHES_AT_ONCE):
        spans = zip(starts[i : i + _HASHES_AT_ONCE], ends[i : i + _HASHES_AT_ONCE])
        hashes = b"".join([digest(joined[a:b], SHINGLE_SEED) for a, b in spans])
        rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every text, whole; zero for a text without words."""

    @F.pandas_udf(T.LongType())
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash_of(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", simhash(whole()).alias("fp"))


def _band_masks(bands: int) -> list[int]:
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def pivots(bands: int = BANDS, per_band: int = PIVOTS_PER_BAND) -> list[list[int]]:
    """Random reference fingerprints, ``per_band`` inside each band."""
    rng = np.random.default_rng(PIVOT_SEED)
    return [
        [int.from_bytes(rng.bytes(8), "big") & mask for _ in range(per_band)] for mask in _band_masks(bands)
    ]


def _distance(column: Column, to: int) -> Column:
    return F.bit_count(column.bitwiseXOR(F.lit(_signed(to))))


def pivot_distances(reps: DataFrame, references: list[list[int]]) -> DataFrame:
    """``reps`` (fp, id) with the distance to the zero pivot (p) and, eight to a long, to every other (p0, p1, ...)."""
    flat = [p for band in references for p in band]
    columns = {"p": F.bit_count("fp")}
    for i in range(0, len(flat), 8):
        packed = F.lit(0).cast("long")
        for j, to in enumerate(flat[i : i + 8]):
            packed = packed.bitwiseOR(F.shiftleft(_distance(F.col("fp"), to).cast("long"), 8 * j))
        columns[f"p{i // 8}"] = packed
    return reps.withColumns(columns)


def _coordinate(name: str, j: int, side: str = "") -> Column:
    return F.shiftright(F.col(f"{side}{name}"), 8 * j).bitwiseAND(F.lit(255))


def _within(n_pivots: int) -> Column:
    """No pivot distance of the pair (x, y) differs by more than the limit."""
    near = F.abs(F.col("x.p") - F.col("y.p")) <= BITS
    for k in range(n_pivots):
        name, j = f"p{k // 8}", k % 8
        near = near & (F.abs(_coordinate(name, j, "x.") - _coordinate(name, j, "y.")) <= BITS)
    return near


def simhash_links(
    reps: DataFrame, *, bands: int = BANDS, per_band: int = PIVOTS_PER_BAND, pair_cell: int = PAIR_CELL
) -> DataFrame:
    """Edges (a, b) between ids of distinct fingerprints that connect exactly those that differ in up to two bits.

    ``reps`` (fp, id) has one row per distinct fingerprint and is read more
    than once. In small cells every verified pair is an edge. In large cells
    the members of a neighbourhood are tied to its smallest id, which joins the
    same components.
    """
    references, masks = pivots(bands, per_band), _band_masks(bands)
    n_pivots = bands * per_band
    coordinates = [c for c in (f"p{i}" for i in range(-(-n_pivots // 8)))]
    placed = pivot_distances(reps, references)
    tables = []
    for number, chosen in enumerate(combinations(range(bands), bands - BITS)):
        relative = [
            (_coordinate(f"p{k // 8}", k % 8) - F.col("p")).cast("byte")
            for band in chosen
            for k in range(band * per_band, (band + 1) * per_band)
        ]
        free = ((1 << 64) - 1) ^ sum(masks[band] for band in chosen)
        tables.append((number, F.xxhash64(F.lit(number), *relative), free))
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("t"), key.alias("key")) for n, key, _ in tables]))
    entries = placed.select("fp", "id", "p", *coordinates, cells.alias("cell")).select(
        "fp", "id", "p", *coordinates, "cell.t", "cell.key"
    )
    light = placed.select(cells.alias("cell")).groupBy("cell.t", "cell.key").agg(F.count("*").alias("members"))
    shared = light.filter("members > 1").select(F.col("t").alias("ct"), F.col("key").alias("ckey"), "members")
    members = materialize(
        entries.join(shared, (F.col("t") == F.col("ct")) & (F.col("key") == F.col("ckey"))).drop("ct", "ckey"), "cells"
    )

    small = members.filter(F.col("members") <= pair_cell)
    x, y = small.alias("x"), small.alias("y")
    same_cell = (F.col("x.t") == F.col("y.t")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id"))
    pairs = (
        x.join(y, same_cell & _within(n_pivots) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= BITS))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    )

    # The zero flip stands for the fingerprint itself.
    flips = F.lit(None).cast("array<bigint>")
    for number, _, free in tables:
        single = [0] + [_signed(1 << i) for i in range(64) if free >> i & 1]
        flips = F.when(F.col("t") == number, F.array(*[F.lit(f).cast("long") for f in single])).otherwise(flips)
    large = members.filter(F.col("members") > pair_cell)
    around = large.select("id", F.col("fp"), F.explode(flips).alias("flip")).select(
        "id", F.col("fp").bitwiseXOR(F.col("flip")).alias("neighbour")
    )
    stars = (
        around.groupBy("neighbour").agg(F.collect_set("id").alias("ids")).filter(F.size("ids") > 1)
        .select(F.array_min("ids").alias("a"), F.explode("ids").alias("b")).filter("a != b")
    )
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 3, pair_cell: int = PAIR_CELL) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Fingerprints link at two differing bits or fewer; ``component_id`` is
    the smallest id reachable by links. Texts without words have fingerprint
    zero and link like any other. Rows that repeat an id or a text share its
    fingerprint and component. A row whose id is null gets its fingerprint and
    a null component.
    """
    with small_batches(docs.sparkSession):
        found = materialize(fingerprints(docs, shingle=shingle), "fingerprints")
    reps = materialize(
        found.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct-fingerprints"
    )
    groups = connected_components(simhash_links(reps, pair_cell=pair_cell))
    labels = reps.join(groups, F.col("id") == F.col("node"), "left").select(
        F.col("fp").alias("label_fp"), F.coalesce("component", "id").alias("component_id")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return found.join(labels, F.col("fp") == F.col("label_fp"), "left").select("doc_id", "fp", component)


def fingerprint_text(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
