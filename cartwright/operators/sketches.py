"""Percentiles that add up: quantile sketches with a stated error.

Exact percentiles need all values of a group at once. A sketch holds a bounded
number of them, and the sketch of two sets of rows is the merge of theirs, so
a stored sketch per group and month takes late rows without a second look at
the month, and any span of months is answered from its months. Sketches are
built inside each task before they meet, so a hot group costs one per task.

Up to about ``size`` values a sketch is exact; beyond, the value that it gives
for percentile p has a true rank within ``rank_error(size)`` of p.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 800
ROWS, SKETCH = "sketched_rows", "sketch"


def rank_error(size: int = SIZE) -> float:
    """Largest distance between the wanted and the true rank, as a share of the rows.

    This is twice the published error at 99 % confidence, so that many sketches
    may be read without one beyond it.
    """
    # fixed values: error of the sketch's library for a single rank, as a function of its size
    return 2 * 2.296 / size**0.9021


def sketch_values(df: DataFrame, keys: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """One sketch of the values that are not NULL per combination of ``keys``."""
    known = df.filter(F.col(value).isNotNull()).withColumn(value, F.col(value).cast("double"))
    return known.groupBy(*keys).agg(
        F.count("*").alias(ROWS), F.kll_sketch_agg_double(value, size).alias(SKETCH)
    )


def merge_sketches(sketches: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """One sketch per combination of ``keys``, which may be fewer than before."""
    return sketches.groupBy(*keys).agg(
        F.sum(ROWS).alias(ROWS), F.kll_merge_agg_double(SKETCH, size).alias(SKETCH)
    )


def read_percentiles(sketches: DataFrame, wanted: Mapping[str, float]) -> DataFrame:
    """The percentiles as columns in place of the sketch."""
    return sketches.withColumns(
        {name: F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))) for name, p in wanted.items()}
    ).drop(SKETCH)


def rank_misses(
    df: DataFrame, group: str, value: str, percentiles: DataFrame, wanted: Mapping[str, float]
) -> DataFrame:
    """How far the true rank of each percentile is from the wanted one, per group, as a share of its rows.

    A value that occurs several times covers all its ranks. One read of ``df``;
    ``percentiles`` has one row per group.
    """
    known = df.filter(F.col(value).isNotNull()).select(F.col(group).alias("__g"), F.col(value).alias("__v"))
    met = known.join(percentiles.select(group, *wanted), F.col("__g").eqNullSafe(F.col(group)))
    counts = [
        F.count_if(test).alias(f"{name}__{end}")
        for name in wanted
        for end, test in (("below", F.col("__v") < F.col(name)), ("upto", F.col("__v") <= F.col(name)))
    ]
    counted = met.groupBy(group).agg(F.count("*").alias("__n"), *counts)
    misses = [
        F.greatest(
            F.col(f"{name}__below") / F.col("__n") - F.lit(float(p)),
            F.lit(float(p)) - F.col(f"{name}__upto") / F.col("__n"),
            F.lit(0.0),
        ).alias(name)
        for name, p in wanted.items()
    ]
    return counted.select(group, F.col("__n").alias("rows"), *misses)
