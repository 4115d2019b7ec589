"""How far the sources of a language differ in their words, pair by pair and term by term.

Terms are counted per (language, source) inside the tasks that read the texts.
Terms of enough documents of a language are kept; each gets a number, and a
group becomes sorted arrays of (term number, count), cut into blocks of terms,
so that neither a large vocabulary nor a large group is ever one value.

Every unordered pair of groups and block of terms is one task: the two arrays
are co-grouped and merged, the shorter galloping through the longer. A merge
prices the terms of both, and those of one side against the other's price of a
term that does not occur; terms that neither has are priced once per pair from
their number. Prices of a pair hold both ways.

All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.runtime import materialize

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: About this many terms make a block; arrays of a block are what a pair task holds.
BLOCK_TERMS = 16_384
#: A task sends its counts on when it holds this many.
HELD_TERMS = 400_000
_GALLOP = 64

#: A-Z to lower case, other ASCII characters but a-z to a space; bytes of other characters stay.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

Group = tuple[str, str]


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters a-z and characters beyond ASCII in a UTF-8 text, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of all rows; every group also has a row with a null term."""

    def rows(held: dict[Group, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, texts) in held.items():
            terms = [*times, None]
            n = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(lang, n),
                    pa.repeat(source, n),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([*times.values(), 0], pa.int64()),
                    pa.array([*(texts[t] for t in times), 0], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[Group, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for text, lang, source in zip(texts, langs, sources):
                times, seen = held.setdefault((lang, source), (Counter(), Counter()))
                terms = terms_of(text.as_py())
                size -= len(times)
                times.update(terms)
                seen.update(set(terms))
                size += len(times)
                if size > HELD_TERMS:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = named.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _price(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms)), beyond 64 bits where needed."""
    wide = "decimal(38,0)"
    above = (count + SMOOTHING).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + SMOOTHING * terms).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", above.cast(wide), below.cast(wide)).cast("long")


def prices(counts: np.ndarray, below: int) -> np.ndarray:
    """The same prices of an array of counts, by long division in three steps of a thousand."""
    rest, price = counts + SMOOTHING, np.ones(len(counts), np.int64)
    for unit in (1_000_000, 1_000, 1):
        digits, rest = np.divmod(rest * 1000, below)
        price += digits * unit
    return price


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common numbers in two rising arrays.

    The short one is taken a few numbers at a time; steps through the long one
    double until they pass the last of them, and only what was passed is searched.
    """
    in_short, in_long, at = [], [], 0
    for start in range(0, len(short), _GALLOP):
        few = short[start : start + _GALLOP]
        step = _GALLOP
        while at + step < len(long) and long[at + step] < few[-1]:
            step *= 2
        window = long[at : at + step + 1]
        place = np.searchsorted(window, few)
        hit = np.flatnonzero(place < len(window))
        hit = hit[window[place[hit]] == few[hit]]
        in_short.append(start + hit)
        in_long.append(at + place[hit])
        at += int(place[-1])
    empty = [np.empty(0, np.int64)]
    return np.concatenate(in_short or empty), np.concatenate(in_long or empty)


def merge_price(
    one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], below_one: int, below_two: int
) -> tuple[int, int]:
    """(sum of price differences, number of terms) over the terms that either array has."""
    if len(one[0]) > len(two[0]):
        one, two, below_one, below_two = two, one, below_two, below_one
    a, b = gallop(one[0], two[0])
    p, q = prices(one[1], below_one), prices(two[1], below_two)
    none_p, none_q = (int(prices(np.zeros(1, np.int64), below)[0]) for below in (below_one, below_two))
    both = np.abs(p[a] - q[b]).sum()
    only_p = np.abs(np.delete(p, a) - none_q).sum()
    only_q = np.abs(np.delete(q, b) - none_p).sum()
    return int(both + only_p + only_q), len(p) + len(q) - len(a)


def pair_values(groups: DataFrame, arrays: DataFrame) -> DataFrame:
    """(lang, lo, hi, value) of every unordered pair of sources of a language.

    ``groups``: lang, source, total (occurrences of kept terms), terms (kept
    terms of the language). ``arrays``: lang, source, block, ids, counts. Both
    must be stored tables.
    """
    side = lambda s: groups.select("lang", F.col("source").alias(s), F.col("total").alias(f"{s}_total"))
    pairs = (
        side("lo").join(side("hi"), "lang").filter("lo < hi")
        .join(groups.select("lang", "terms").distinct(), "lang")
    )
    keys = ["lang", "lo", "hi", "block"]

    def arrays_of(s: str) -> DataFrame:
        own = arrays.select("lang", F.col("source").alias(s), "block", "ids", "counts")
        facts = ["lo_total", "hi_total", "terms", "ids", "counts"]
        # Columns of its own for each side, which a co-group of one table with itself asks for.
        return own.join(pairs, ["lang", s]).select(*[F.col(c).alias(c) for c in [*keys, *facts]])

    def merge(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        def array(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            if not side.num_rows:
                return np.empty(0, np.int64), np.empty(0, np.int64)
            return tuple(np.asarray(side.column(c).combine_chunks().flatten()) for c in ("ids", "counts"))

        facts = (left if left.num_rows else right).slice(0, 1).to_pylist()[0]
        below = [facts[c] + SMOOTHING * facts["terms"] for c in ("lo_total", "hi_total")]
        value, terms = merge_price(array(left), array(right), *below)
        lang, lo, hi, _ = key
        return pa.table(
            {"lang": pa.array([lang.as_py()]), "lo": pa.array([lo.as_py()]), "hi": pa.array([hi.as_py()]),
             "priced": pa.array([value], pa.int64()), "seen": pa.array([terms], pa.int64())}
        )

    merged = (
        arrays_of("lo").groupBy(*keys).cogroup(arrays_of("hi").groupBy(*keys))
        .applyInArrow(merge, "lang string, lo string, hi string, priced bigint, seen bigint")
        .groupBy("lang", "lo", "hi").agg(F.sum("priced").alias("priced"), F.sum("seen").alias("seen"))
    )
    absent = F.abs(
        _price(F.lit(0), F.col("lo_total"), F.col("terms")) - _price(F.lit(0), F.col("hi_total"), F.col("terms"))
    )
    seen = F.coalesce("seen", F.lit(0))
    value = F.when(F.col("terms") == 0, F.lit(0)).otherwise(
        F.coalesce("priced", F.lit(0)) + (F.col("terms") - seen) * absent
    )
    return pairs.join(merged, ["lang", "lo", "hi"], "left").select("lang", "lo", "hi", value.cast("long").alias("value"))


def source_divergence(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (language, source) group of ``docs``.

    Null texts, languages and sources count as empty ones; every row is a
    document, so rows may repeat. Further columns are not read.

    Part ``pair`` has a row for each other source of the language: the sum of
    price differences over all kept terms, 0 if the language keeps none; a
    language of one source has none. Part ``term`` has the ``top`` kept terms
    that occur in the group and cost more there than in the language as a
    whole. Ranks fall with the value, ties go by the item's UTF-8 bytes. An
    empty table gives an empty result.
    """
    counted = materialize(count_terms(docs), "term-counts")
    kept = (
        counted.filter("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).filter(F.col("docs") >= min_docs).drop("docs")
    )
    kept = materialize(kept, "kept-terms")
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    largest = vocabulary.agg(F.max("terms")).first()[0] or 0
    blocks = max(1, -(-largest // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    in_block = Window.partitionBy("lang", "block").orderBy("term")
    numbered = kept.withColumn("block", block).withColumn("id", (F.row_number().over(in_block) - 1).cast("long"))
    found = materialize(
        counted.filter("term IS NOT NULL").join(numbered, ["lang", "term"])
        .select("lang", "source", "term", "block", "id", "n", "in_lang"),
        "kept-counts",
    )
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialize(
        counted.filter("term IS NULL").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")]),
        "groups",
    )
    entries = F.array_sort(F.collect_list(F.struct("id", "n")))
    arrays = materialize(
        found.groupBy("lang", "source", "block").agg(entries.alias("entries"))
        .select("lang", "source", "block", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts")),
        "term-arrays",
    )
    pairs = materialize(pair_values(groups, arrays), "pair-values")
    names = ["lang", "source", "item", "value"]
    both_ways = pairs.select("lang", F.col("lo").alias("source"), F.col("hi").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("hi").alias("source"), F.col("lo").alias("item"), "value")
    )
    here = _price(F.col("n"), F.col("total"), F.col("terms"))
    anywhere = _price(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    over = (
        found.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), (here - anywhere).alias("value")).filter("value > 0")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    # The limit on ranks reaches the tasks before the shuffle, so a large group sends on few rows of each.
    ranked_terms = over.select(*names, rank).filter(F.col("rank") <= top)
    return both_ways.select(*names, rank).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        ranked_terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )
