"""Exact interpolated percentiles per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.operators.ranking import PART, POS, ranged_copy


def distributed_percentiles(
    df: DataFrame,
    group: str,
    value: str,
    wanted: dict[str, float],
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Percentiles of groups that may hold any number of distinct values.

    Equal values are counted before the shuffle and cut into range partitions
    of (group, value). The row counts of the partitions tell which of them hold
    the two ranks around each percentile, and only those are searched, so no
    task ever holds more of a group than one partition.

    ``sums`` are further columns to add up per group, over rows without a value
    as well; they ride on the value counts, so ``df`` is read once for both. A
    group without any value has no row.
    """
    sums = sums or {}
    # A NULL value counts no row, so no rank falls on it.
    counts = df.groupBy(F.col(group).alias("__g"), F.col(value).alias("__v")).agg(
        F.count(value).alias("__n"), *[F.sum(c).alias(name) for name, c in sums.items()]
    )
    ranged = ranged_copy(counts, ["__g", "__v"])
    earlier = Window.partitionBy("__g").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    spans = ranged.groupBy("__g", PART).agg(F.sum("__n").alias("__rows")).withColumns(
        {
            "__first": F.coalesce(F.sum("__rows").over(earlier), F.lit(0)),
            "__total": F.sum("__rows").over(Window.partitionBy("__g")),
        }
    )
    places = {name: F.lit(float(p)) * (F.col("__total") - 1) for name, p in wanted.items()}
    slots = [
        F.struct(F.lit(f"{name}{end}").alias("slot"), rank(place).alias("rank"))
        for name, place in places.items()
        for end, rank in (("__lo", F.floor), ("__hi", F.ceil))
    ]
    searched = (
        spans.withColumn("__s", F.explode(F.array(*slots)))
        .filter("__s.rank >= __first AND __s.rank < __first + __rows")
        .select(
            F.col("__g").alias("__of"),
            F.col(PART).alias("__in"),
            "__total",
            F.col("__s.slot").alias("__slot"),
            (F.col("__s.rank") - F.col("__first")).alias("__rank"),
        )
    )
    inside = Window.partitionBy("__g", PART).orderBy(POS).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = (
        ranged.withColumn("__upto", F.sum("__n").over(inside))
        .join(searched, F.col("__g").eqNullSafe(F.col("__of")) & (F.col(PART) == F.col("__in")))
        .filter("__rank < __upto AND __rank >= __upto - __n")
    )
    picks = [
        F.max(F.when(F.col("__slot") == f"{name}{end}", F.col("__v"))).alias(f"{name}{end}")
        for name in wanted
        for end in ("__lo", "__hi")
    ]
    picked = found.groupBy("__g").agg(F.max("__total").alias("__total"), *picks)
    result = [F.col("__g").alias(group), *sums]
    for name, place in places.items():
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        result.append((low + (high - low) * (place - F.floor(place))).alias(name))
    if sums:
        added = ranged.groupBy(F.col("__g").alias("__of")).agg(*[F.sum(c).alias(c) for c in sums])
        picked = picked.join(added, F.col("__g").eqNullSafe(F.col("__of")))
    return picked.select(*result)
