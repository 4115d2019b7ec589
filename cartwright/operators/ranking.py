"""Global ordering without a one-task window.

``Window.orderBy`` without a partition sends every row to one task, and
``Window.partitionBy(k)`` sends a hot ``k`` to one task. The jobs here cut a
total order into range partitions, number or sum inside each, and add what the
partitions before it contributed. The only data broadcast is one row per range
partition (plus one per group that crosses a partition border), which is
bounded by ``spark.sql.shuffle.partitions`` and not by the input.

The range-partitioned table is written to the shared folder before it is
counted, so that counting and numbering see the same cut even when executors
are lost in between.

Sort keys are Columns read in ascending order. Callers turn a descending key
into its negation and a NULL into a leading 0/1 flag, so no key is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.runtime import materialize

PART = "__part"
POS = "__pos"


def ranged_copy(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored copy of ``df`` in range partitions, each row with its place in one."""
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(
            POS, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        )
    )
    return materialize(placed, "ranged")


# --------------------------------------------------------------------- ntile


def _tile_of(position: Column, total: Column, tiles: int) -> Column:
    """Tile (from 1) of a 0-based position: the first ``total % tiles`` get one row more."""
    small = F.floor(total / tiles)
    larger = total % tiles
    edge = larger * (small + 1)
    return (
        F.when(position < edge, F.floor(position / (small + 1)))
        .otherwise(larger + F.floor((position - edge) / F.greatest(small, F.lit(1))))
        .cast("int")
        + 1
    )


def distributed_ntile(
    df: DataFrame, tiles: int, orders: dict[str, Sequence[Column]], key: str
) -> DataFrame:
    """Exact NTILE columns over several total orders at once.

    All orders share one range-partitioned sort of (order number, sort keys,
    key). Only the first row of each tile is looked up, ``tiles - 1`` rows per
    order, and every input row is then placed by comparing itself with those
    rows: no shuffle of the full rows and no join back.

    ``key`` must be unique; it breaks ties. ``df`` is read twice, so pass a
    stored table.
    """
    slots: list[tuple[str, int, Column]] = []
    for number, columns in enumerate(orders.values()):
        slots += [(f"k{number}_{i}", number, c) for i, c in enumerate(columns)]
    kinds = df.select([c.alias(slot) for slot, _, c in slots]).schema

    def entry(number: int) -> Column:
        return F.struct(
            F.lit(number).alias("order_no"),
            *[
                (c if owner == number else F.lit(None).cast(kinds[slot].dataType)).alias(slot)
                for slot, owner, c in slots
            ],
            F.col(key).alias("key"),
        )

    entries = df.select(F.inline(F.array(*[entry(n) for n in range(len(orders))])))
    ranged = ranged_copy(entries, ["order_no", *[slot for slot, _, _ in slots], "key"])

    before = Window.partitionBy("order_no").orderBy(PART)
    shares = (
        ranged.groupBy("order_no", PART)
        .agg(F.count("*").alias("rows"), F.min(POS).alias("first_pos"))
        .withColumn("offset", F.sum("rows").over(before) - F.col("rows") - F.col("first_pos"))
        .withColumn("total", F.sum("rows").over(Window.partitionBy("order_no")))
        .select("order_no", PART, "offset", "total")
    )
    numbered = ranged.join(F.broadcast(shares), ["order_no", PART]).withColumn(
        "position", F.col(POS) + F.col("offset")
    )
    tile = _tile_of(F.col("position"), F.col("total"), tiles)
    previous = _tile_of(F.col("position") - 1, F.col("total"), tiles)
    starts = (
        numbered.filter((F.col("position") > 0) & (tile != previous)).drop(PART, POS).collect()
    )

    added = {}
    for number, (name, columns) in enumerate(orders.items()):
        own = [slot for slot, owner, _ in slots if owner == number]
        here = F.struct(*[c.alias(s) for s, c in zip(own, columns)], F.col(key).alias("key"))
        tile_no = F.lit(1)
        for row in (r for r in starts if r["order_no"] == number):
            start = F.struct(
                *[F.lit(row[s]).cast(kinds[s].dataType).alias(s) for s in own],
                F.lit(row["key"]).cast(df.schema[key].dataType).alias("key"),
            )
            tile_no = tile_no + (here >= start).cast("int")
        added[name] = tile_no
    return df.withColumns(added)


# --------------------------------------------------------------- running sums


def distributed_running_sum(
    df: DataFrame, order: str, value: str, *, running: str, total: str, rank: str
) -> DataFrame:
    """The same three columns, exact, without a one-task window.

    Rows that tie on ``order`` share a result, so the job works on one row per
    distinct order value: a value held by a third of the rows is summed before
    the shuffle and cannot make a heavy partition. ``df`` is read twice, so
    pass a stored table.
    """
    levels = df.groupBy(F.col(order).alias("__level")).agg(
        F.sum(value).alias("__sum")
    ).withColumns({
        "__null": F.when(F.col("__level").isNull(), 0).otherwise(1),
        "__desc": -F.col("__level"),
    })
    ranged = ranged_copy(levels, ["__null", "__desc"])
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        ranged.groupBy(PART)
        .agg(F.sum("__sum").alias("part_sum"), F.count("*").alias("part_rows"))
        .withColumns(
            {
                "sum_before": F.coalesce(F.sum("part_sum").over(before), F.lit(0)),
                "rows_before": F.coalesce(F.sum("part_rows").over(before), F.lit(0)),
                "grand_total": F.sum("part_sum").over(Window.partitionBy()),
            }
        )
        .select(PART, "sum_before", "rows_before", "grand_total")
    )
    inside = Window.partitionBy(PART).orderBy(POS).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = (
        ranged.withColumn("sum_inside", F.sum("__sum").over(inside))
        .join(F.broadcast(shares), PART)
        .select(
            "__level",
            (F.col("sum_before") + F.col("sum_inside")).alias(running),
            F.col("grand_total").alias(total),
            (F.col("rows_before") + F.col(POS) + 1).cast("int").alias(rank),
        )
    )
    return df.join(placed, F.col(order).eqNullSafe(F.col("__level"))).drop("__level")


def grouped_running_sum(
    df: DataFrame, group: str, order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Running sum of ``value`` inside each ``group``, by ``order``.

    The range cut runs over (group, order), so a group with a third of all rows
    covers a third of the partitions. A partition border crosses at most one
    group, hence at most one carried row per range partition is broadcast.
    """
    ranged = ranged_copy(df, [group, *order])
    parts = ranged.groupBy(group, PART).agg(F.sum(value).alias("__part_sum"))
    earlier = Window.partitionBy(group).orderBy(PART).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        parts.withColumn("__carried", F.sum("__part_sum").over(earlier))
        .filter(F.col("__carried").isNotNull())
        .select(F.col(group).alias("__group"), F.col(PART).alias("__to"), "__carried")
    )
    inside = Window.partitionBy(group, PART).orderBy(POS).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = ranged.withColumn("__inside", F.sum(value).over(inside))
    joined = summed.join(
        F.broadcast(carried),
        F.col(group).eqNullSafe(F.col("__group")) & (F.col(PART) == F.col("__to")),
        "left",
    )
    return joined.withColumn(
        out, F.col("__inside") + F.coalesce(F.col("__carried"), F.lit(0))
    ).drop("__group", "__to", "__carried", "__inside", PART, POS)
