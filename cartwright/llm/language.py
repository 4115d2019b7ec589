"""Language identification with hyperdimensional profiles.

Every letter has a random vector of -1 and +1. A letter n-gram is the product
(binding) of its letters' vectors, each rotated (permuted) by its place; a text
is the sum (bundle) of its n-grams; a language is the sum over its training
texts. A text gets the language whose prototype has the largest cosine.

All bundles hold whole numbers, so the prototypes do not depend on how Spark
deals the texts out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.text import packed, whole
from cartwright.runtime import small_batches

DIMENSIONS = 1024
GRAM = 3
SEED = 7
UNDETERMINED = "und"
#: Letters are dealt to this many vectors by code point; those of one alphabet do not collide.
SLOTS = 509
#: Vectors of this many n-grams are kept by a worker, others are bound each time; training binds the n-grams of a language when it has counted so many.
KEPT_GRAMS = 1 << 15
_CHUNK = 1 << 8


@cache
def _slot_of_code_point() -> np.ndarray:
    """0 for anything but a letter, else the number of its vector."""
    points = np.arange(0x110000)
    letters = np.fromiter((chr(c).isalpha() for c in points), bool, len(points))
    return np.where(letters, points % SLOTS + 1, 0).astype(np.int16)


class Encoder:
    """Bundles of texts. Slot 0 stands for any run of other characters, so n-grams see where words begin."""

    def __init__(self, dimensions: int = DIMENSIONS):
        rng = np.random.default_rng(SEED)
        letters = rng.integers(0, 2, (SLOTS + 1, dimensions), dtype=np.int8) * 2 - 1
        self._rotated = [np.roll(letters, GRAM - 1 - i, axis=1) for i in range(GRAM)]
        self._rows: dict[int, int] = {}
        self._vectors = np.empty((KEPT_GRAMS, dimensions), np.int8)
        self._taken = np.empty((_CHUNK, dimensions), np.int8)
        self._wide = np.empty((_CHUNK, dimensions), np.float32)
        self.dimensions = dimensions

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the distinct n-grams and their counts; none if the text has no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        slots = _slot_of_code_point()[points]
        if not slots.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        slots = np.concatenate(([0], slots, [0]))
        kept = np.ones(len(slots), bool)
        kept[1:] = (slots[1:] != 0) | (slots[:-1] != 0)
        slots = slots[kept]
        codes = np.zeros(len(slots) - GRAM + 1, np.int64)
        for i in range(GRAM):
            codes = codes * (SLOTS + 1) + slots[i : len(slots) - GRAM + 1 + i]
        return np.unique(codes, return_counts=True)

    def _bind(self, codes: np.ndarray) -> np.ndarray:
        bound = np.ones((len(codes), self.dimensions), np.int8)
        for i in reversed(range(GRAM)):
            codes, slot = np.divmod(codes, SLOTS + 1)
            bound *= self._rotated[i][slot]
        return bound

    def _places(self, codes: np.ndarray) -> np.ndarray | None:
        """Where the vectors of these n-grams are kept, if there is room for all of them."""
        rows = self._rows
        new = [c for c in codes.tolist() if c not in rows]
        if len(rows) + len(new) > KEPT_GRAMS:
            return None
        if new:
            start = len(rows)
            self._vectors[start : start + len(new)] = self._bind(np.array(new))
            rows.update(zip(new, range(start, start + len(new))))
        return np.array([rows[c] for c in codes.tolist()], np.int64)

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(self.dimensions)
        for i in range(0, len(codes), _CHUNK):
            part = codes[i : i + _CHUNK]
            places = self._places(part)
            wide = self._wide[: len(part)]
            if places is None:
                wide[:] = self._bind(part)
            else:
                wide[:] = np.take(self._vectors, places, axis=0, out=self._taken[: len(part)], mode="clip")
            total += counts[i : i + _CHUNK].astype(np.float32) @ wide
        return total


def held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """Whether the CRC-32 of the id's text has this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def train_prototypes(docs: DataFrame, *, dimensions: int = DIMENSIONS) -> dict[str, list[float]]:
    """The prototype of every non-null ``lang`` of ``docs``.

    Each task counts n-grams per language, batch after batch, and sends one
    bundle for each; the driver receives ``dimensions`` sums per language. Texts without a letter
    teach nothing.
    """

    def bundles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums, counted = Encoder(dimensions), {}, {}

        def bind(lang: str) -> None:
            codes, counts = counted.pop(lang)
            for i in range(0, len(codes), _CHUNK):
                sums[lang] += counts[i : i + _CHUNK] @ encoder._bind(codes[i : i + _CHUNK]).astype(np.int64)

        for batch in batches:
            for lang, texts in batch.groupby("lang").text:
                sums.setdefault(lang, np.zeros(dimensions, np.int64))
                found = [encoder.grams(t) for t in texts]
                found += [counted[lang]] if lang in counted else []
                codes, inverse = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                counts = np.zeros(len(codes), np.int64)
                np.add.at(counts, inverse, np.concatenate([n for _, n in found]))
                counted[lang] = codes, counts
                if len(codes) > KEPT_GRAMS:
                    bind(lang)
        for lang in list(counted):
            bind(lang)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "bundle": [s.tolist() for s in sums.values()]})

    learned = docs.filter(F.col("lang").isNotNull()).select("lang", whole().alias("text"))
    sums = (
        learned.mapInPandas(bundles, "lang string, bundle array<long>")
        .select("lang", F.posexplode("bundle").alias("i", "x"))
        .groupBy("lang", "i").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("bundle"))
        .select("lang", F.col("bundle.x").alias("bundle"))
    )
    with small_batches(docs.sparkSession):
        rows = sums.collect()
    return {r["lang"]: [float(x) for x in r["bundle"]] for r in rows if any(r["bundle"])}


def identify(docs: DataFrame, prototypes: dict[str, list[float]], *, dimensions: int = DIMENSIONS) -> DataFrame:
    """``row`` (all input columns), ``lang_pred``, ``score`` and ``cosines`` for every row of ``docs``.

    ``score`` is the cosine with the predicted language's prototype, at least
    0; ``cosines`` are those with all prototypes, languages by code point. A
    null text, one without a letter, and any text if there are no prototypes
    are ``und`` with score 0 and no cosines. Ties go to the language that
    comes first by code point.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), dimensions)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)

    @F.pandas_udf("lang_pred string, score double, cosines array<double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(dimensions)
        for texts in batches:
            langs, scores, all_cosines = [], [], []
            for text in texts:
                codes, counts = encoder.grams(text)
                bundle = encoder.bundle(codes, counts)
                norm = np.linalg.norm(bundle)
                if not len(names) or not norm:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    all_cosines.append([])
                    continue
                cosines = matrix @ bundle / norm
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
                all_cosines.append(cosines.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "cosines": all_cosines})

    return docs.select(packed(docs).alias("row"), predict(whole()).alias("found")).select(
        "row", "found.lang_pred", "found.score", "found.cosines"
    )


def judge_labels(
    found: DataFrame, languages: list[str], *, foreign_share: float = 0.25, lead_share: float = 0.5
) -> DataFrame:
    """``found`` (of ``identify``, stored) with ``foreign`` and ``relabelled``, by bounds learnt from it.

    Texts are compared with those of the same predicted language and order of
    length. ``foreign``: undetermined, or a score below ``foreign_share`` of
    the first quartile there: none of the languages. ``relabelled``: the text is nearer to
    the predicted language than to that of its label by more than ``lead_share``
    of the median lead that well-labelled texts have there, or has no label of a
    known language. Half of the labels may be wrong without moving the bounds
    much. ``languages`` are those of the prototypes.

    What is learnt is one row per language and power of two of the length.
    """
    order = sorted(languages)
    cosine_of = lambda lang: F.try_element_at("cosines", F.array_position(F.lit(order), lang).cast("int"))
    own = F.when(F.array_contains(F.lit(order), F.col("row.lang")), cosine_of(F.col("row.lang")))
    runner_up = F.array_max(F.filter("cosines", lambda c, i: i != F.array_position(F.lit(order), F.col("lang_pred")) - 1))
    size = F.floor(F.log2(F.greatest(F.length("row.text"), F.lit(1)))).cast("int")
    sized = found.withColumns({"__size": size, "__lead": F.coalesce(F.col("score") - runner_up, F.col("score")), "__own": own})
    learnt = (
        sized.filter(F.col("lang_pred") != UNDETERMINED).groupBy("lang_pred", "__size")
        .agg(
            F.percentile_approx("score", 0.25).alias("__low"),
            F.percentile_approx(F.when(F.col("row.lang") == F.col("lang_pred"), F.col("__lead")), 0.5).alias("__usual"),
        )
        .withColumnsRenamed({"lang_pred": "__lang", "__size": "__of_size"})
    )
    # So few rows whatever the corpus: texts stay where they are, and most of them share one key.
    joined = sized.join(F.broadcast(learnt), (F.col("lang_pred") == F.col("__lang")) & (F.col("__size") == F.col("__of_size")), "left")
    undetermined = F.col("lang_pred") == UNDETERMINED
    away = (F.col("score") - F.col("__own")) > lead_share * F.coalesce("__usual", F.lit(float("inf")))
    return joined.select(
        *found.columns,
        (undetermined | F.coalesce(F.col("score") < foreign_share * F.col("__low"), F.lit(False))).alias("foreign"),
        (~undetermined & (F.col("__own").isNull() | ((F.col("row.lang") != F.col("lang_pred")) & away))).alias("relabelled"),
    )
