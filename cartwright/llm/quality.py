"""Quality rules: base rules and robust multivariate outliers.

Statistics of each text are turned into a vector. For every group of language
and source a minimum-covariance-determinant estimate says what is usual there,
and a text far from it by Mahalanobis distance is rejected. The estimate of a
group is drawn towards that of its language, and that of a language towards
everyone's, the more the fewer texts it rests on.

The estimate is refined by concentration steps: the half of a group closest to
the present centre gives the next centre and covariance. A step is one pass:
counts and moments per group and distance class are summed inside each task
before they move, so a group with a third of all rows is as cheap as any. All
rows count; nothing is sampled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.text import whole
from cartwright.runtime import materialize

STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

#: Coordinates of the vector and the least standard deviation of each, for groups whose own is smaller. Most texts have
#: no symbol, double line or repetition at all, so their spread alone would reject the first one. Length has a wide one,
#: so that long clean texts stay.
COORDINATES = {"length": 1.0, "word_length": 0.05, "symbols": 0.03, "dup_lines": 0.05, "repeats": 0.12}
DIM = len(COORDINATES)
#: The language's estimate counts like this many texts of a group, and everyone's like this many of a language.
PRIOR_TEXTS = 100
#: Concentration ends when no determinant falls by this share, or after so many steps.
STEPS, LEAST_FALL = 12, 0.01
#: A text is rejected beyond this squared distance, the 0.9999 quantile of chi-square with five degrees of freedom.
MAX_SQUARED_DISTANCE = 25.7
#: Distance classes of a concentration step: this many per doubling of the squared distance.
CLASSES = 16


def text_statistics(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    # Code points are the bytes that do not continue a character.
    letters = np.frombuffer(b"".join(words), np.uint8)
    word_chars = int(np.count_nonzero((letters & 0xC0) != 0x80))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.split()] if b"\n" in data else []
    n_dup_lines = len(lines) - len(set(lines))
    if n < WINDOW + 1:
        return n, word_chars, n_symbols, n_dup_lines, 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    windows = ids[: n - WINDOW + 1]
    for i in range(1, WINDOW):
        # Numbering the windows so far anew keeps products exact for any vocabulary.
        if len(number) ** (i + 1) >= 1 << 62:
            windows = np.unique(windows, return_inverse=True)[1]
        windows = windows * len(number) + ids[i : n - WINDOW + 1 + i]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    repeated = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for i in range(WINDOW):
        covered[i : n - WINDOW + 1 + i] |= repeated
    return n, word_chars, n_symbols, n_dup_lines, int(covered.sum())


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text column."""

    @F.pandas_udf(STATISTICS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in STATISTICS.split(", ")]
        for texts in batches:
            yield pd.DataFrame([text_statistics(t) for t in texts], columns=names, dtype="int64")

    return count(text)


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def coordinates() -> list[Column]:
    """The transformed vector: logarithms of counts, square roots of shares."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("n_words").cast("double")),
        F.log((F.col("word_chars") + 1) / words),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / words),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _flat(matrix: np.ndarray) -> list[float]:
    return matrix[np.triu_indices(DIM)].tolist()


def _square(flat: np.ndarray) -> np.ndarray:
    full = np.zeros((DIM, DIM))
    full[np.triu_indices(DIM)] = flat
    return full + np.triu(full, 1).T


def _floored(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Covariance with the floors as its least in any direction, its inverse, and the logarithm of its determinant.

    In coordinates that are measured in floors, eigenvalues below 1 count as 1, and all others as they are.
    """
    floor = np.array(list(COORDINATES.values()))
    values, axes = np.linalg.eigh(cov / np.outer(floor, floor))
    values = np.maximum(values, 1)
    out, back = axes * floor[:, None], axes / floor[:, None]
    return (out * values) @ out.T, (back / values) @ back.T, float(np.log(values).sum())


def _estimates(sums: DataFrame) -> DataFrame:
    """Centre, covariance, inverse, determinant from (key, start, n, s, ss): sums of the vectors and of their products.

    The covariance of the inner half is scaled up to that of all points.
    """
    factor = consistency()

    @F.pandas_udf("centre array<double>, covariance array<double>, inverse array<double>, determinant double")
    def estimate(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        rows = []
        for count, s, ss in zip(n, sums, products):
            centre = np.asarray(s) / count
            cov, inverse, determinant = _floored((_square(np.asarray(ss) / count) - np.outer(centre, centre)) / factor)
            rows.append((centre.tolist(), _flat(cov), _flat(inverse), determinant))
        return pd.DataFrame(rows, columns=["centre", "covariance", "inverse", "determinant"])

    return sums.select("key", "start", estimate("n", "s", "ss").alias("e")).select("key", "start", "e.*")


def _sums() -> list[Column]:
    x = [F.col(f"x{i}") for i in range(DIM)]
    return [
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i in range(DIM) for j in range(i, DIM)]).alias("ss"),
    ]


def squared_distance() -> Column:
    """Of x0, x1, ... from ``centre`` under ``inverse``."""
    d = [F.col(f"x{i}") - F.col("centre")[i] for i in range(DIM)]
    terms, k = [], 0
    for i in range(DIM):
        for j in range(i, DIM):
            terms.append(F.col("inverse")[k] * d[i] * d[j] * (1 if i == j else 2))
            k += 1
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _element_sums(name: str, size: int) -> Column:
    return F.array(*[F.sum(F.col(name)[i]) for i in range(size)]).alias(name)


def _starts(points: DataFrame) -> DataFrame:
    """Two first guesses per key, both about the medians: deviations of the floors, and of the quartiles."""
    quartiles = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(DIM)]
    floors = list(COORDINATES.values())

    def inverse(deviations: list[Column]) -> Column:
        zero = F.lit(0.0)
        return F.array(*[1 / (deviations[i] * deviations[i]) if i == j else zero for i in range(DIM) for j in range(i, DIM)])

    # 1.349: quartiles of a normal coordinate are so many deviations apart.
    own = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(v)) for i, v in enumerate(floors)]
    guesses = F.array(
        *[F.struct(F.lit(k).alias("start"), inverse(d).alias("inverse")) for k, d in enumerate(([F.lit(v) for v in floors], own))]
    )
    centre = F.array(*[F.col(f"q{i}")[1] for i in range(DIM)]).alias("centre")
    return points.groupBy("key").agg(*quartiles).select("key", centre, F.explode(guesses).alias("g")).select(
        "key", "g.start", "centre", F.array(*[F.lit(0.0)] * (DIM * (DIM + 1) // 2)).alias("covariance"), "g.inverse",
        F.lit(float("inf")).alias("determinant"),
    )


def robust_estimates(points: DataFrame, *, steps: int = STEPS) -> DataFrame:
    """(key, centre, covariance, inverse): of the most concentrated half of each group's points.

    ``points`` (key, x0, x1, ...) is read once a step. Steps begin at two
    guesses; each keeps the step of least determinant, and the guess that ends
    with the least one is taken. The half is cut at the upper edge of a
    distance class, so it holds at least (n + dimensions + 1) / 2 points.
    Floor variances are the least in any direction: a group whose vectors are
    all alike still has an inverse.
    """
    now = materialize(_starts(points), "estimates")
    nearest = Window.partitionBy("key", "start").orderBy("class")
    within = nearest.rowsBetween(Window.unboundedPreceding, -1)
    for step in range(steps):
        distance_class = F.floor(F.log2(squared_distance() + 1e-6) * CLASSES)
        classes = (
            points.join(now.withColumnRenamed("key", "of"), F.col("key") == F.col("of"))
            .withColumn("class", distance_class)
            .groupBy("key", "start", "class").agg(*_sums())
        )
        half = F.floor((F.sum("n").over(Window.partitionBy("key", "start")) + DIM + 1) / 2)
        inner = classes.withColumn("half", half).withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        kept = inner.filter("before < half").groupBy("key", "start").agg(
            F.sum("n").alias("n"), _element_sums("s", DIM), _element_sums("ss", DIM * (DIM + 1) // 2)
        )
        found = _estimates(kept).withColumn("step", F.lit(step))
        both = found.unionByName(now.withColumn("step", F.lit(step - 1)))
        best = both.groupBy("key", "start").agg(
            F.min_by(F.struct(*[c for c in both.columns if c not in ("key", "start")]), F.struct("determinant", "step")).alias("e"),
            (F.max("determinant") - F.min("determinant")).alias("fall"),
        )
        now = materialize(best.select("key", "start", "e.*", (F.col("fall") > LEAST_FALL).alias("falls")), "estimates")
        going_on = now.filter(F.col("falls") & (F.col("step") == step)).limit(1).count()
        now = now.drop("step", "falls")
        if not going_on:
            break
    last = F.struct("centre", "covariance", "inverse")
    least = now.groupBy("key").agg(F.min_by(last, F.struct("determinant", "start")).alias("e"))
    return least.select("key", "e.*")


def drawn_towards(own: DataFrame, wider: DataFrame, *, prior: int = PRIOR_TEXTS) -> DataFrame:
    """Estimates (key, parent, n, centre, covariance, inverse) of ``own``, each blended with that of its parent in ``wider``.

    An estimate on n texts weighs n / (n + ``prior``), its parent's the rest. The covariance is that of the mixture,
    so a group far from its parent is given room in that direction while its texts are few.
    """

    @F.pandas_udf("centre array<double>, covariance array<double>, inverse array<double>")
    def blend(n: pd.Series, centre: pd.Series, cov: pd.Series, far_centre: pd.Series, far_cov: pd.Series) -> pd.DataFrame:
        rows = []
        for count, c, s, fc, fs in zip(n, centre, cov, far_centre, far_cov):
            w, c, fc = count / (count + prior), np.asarray(c), np.asarray(fc)
            mixed = w * _square(s) + (1 - w) * _square(fs) + w * (1 - w) * np.outer(c - fc, c - fc)
            full, inverse, _ = _floored(mixed)
            rows.append(((w * c + (1 - w) * fc).tolist(), _flat(full), _flat(inverse)))
        return pd.DataFrame(rows, columns=["centre", "covariance", "inverse"])

    parents = wider.select(F.col("key").alias("of"), F.col("centre").alias("far_centre"), F.col("covariance").alias("far_covariance"))
    return own.join(parents, F.col("parent") == F.col("of")).select(
        "key", "n", blend("n", "centre", "covariance", "far_centre", "far_covariance").alias("e")
    ).select("key", "n", "e.*")


def consistency(share: float = 0.5) -> float:
    """Factor by which the covariance of the inner half of normal vectors is too small, for ``DIM`` = 5.

    The cut-off c has P(chi2 with 5 degrees < c) = share, and the factor is
    P(chi2 with 7 degrees < c) / share, both in closed form for odd degrees.
    """

    def below(c: float, degrees: int) -> float:
        total, term = math.erf(math.sqrt(c / 2)), math.sqrt(2 * c / math.pi) * math.exp(-c / 2)
        for k in range(3, degrees + 1, 2):
            total -= term
            term *= c / k
        return total

    low, high = 0.0, 100.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid, DIM) < share else (low, mid)
    return below(low, DIM + 2) / share


def judge_quality(
    docs: DataFrame, *, prior: int = PRIOR_TEXTS, max_squared_distance: float = MAX_SQUARED_DISTANCE
) -> DataFrame:
    """The statistics, ``base_failed``, ``distance`` and ``kept`` of every document.

    Estimates are made from the texts that pass the base rules, per language
    and source (nulls are values of their own), per language, and from all. A
    group's is blended with its language's, which counts like ``prior`` texts,
    and a language's with everyone's: the same rule at every size. ``kept`` is
    false for a text that fails a base rule or whose squared distance is above
    the limit. A null text has no words.
    """
    stats = materialize(
        docs.select("doc_id", "lang", "source", statistics(whole()).alias("stat")).select(
            "doc_id", "lang", "source", "stat.*"
        ),
        "statistics",
    )
    tag = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    both = F.concat_ws("\t", tag, F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
    points = stats.select(
        "*", base_failed().alias("base_failed"), tag.alias("lang_key"), both.alias("group_key"),
        *[c.alias(f"x{i}") for i, c in enumerate(coordinates())],
    )
    passed = points.filter(~F.col("base_failed"))
    # A text is a point of its group, of its language and of all texts; the levels are apart even if their names are not.
    key = lambda level, name: F.concat(F.lit(f"{level}\t"), F.col(name) if name else F.lit(""))
    group, lang, everyone = key(2, "group_key"), key(1, "lang_key"), key(0, "")
    xs = [f"x{i}" for i in range(DIM)]
    # Stored with its keys, so that the one key of all texts is a column to join on and no constant.
    sizes = passed.groupBy(group.alias("group"), lang.alias("lang"), everyone.alias("everyone")).agg(F.count("*").alias("n"))
    sizes = materialize(sizes, "groups")
    spread = materialize(passed.select(F.explode(F.array(group, lang, everyone)).alias("key"), *xs), "points")
    found = materialize(robust_estimates(spread), "levels")

    def level(keys: DataFrame) -> DataFrame:
        return keys.join(found.withColumnRenamed("key", "of"), F.col("key") == F.col("of")).drop("of")

    langs = level(sizes.groupBy(F.col("lang").alias("key"), F.col("everyone").alias("parent")).agg(F.sum("n").alias("n")))
    langs = drawn_towards(langs, found, prior=prior)
    groups = drawn_towards(level(sizes.select(F.col("group").alias("key"), F.col("lang").alias("parent"), "n")), langs, prior=prior)
    groups = materialize(groups.select(F.col("key").alias("of"), "centre", "inverse"), "estimates")
    judged = points.join(groups, group == F.col("of"), "left").withColumn("distance", squared_distance())
    usual = F.coalesce(F.col("distance") <= max_squared_distance, F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & usual).alias("kept"),
    )
