"""File layouts that let frequent lookups skip most of the orders, and joins skip the shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_orders_by_status(orders: DataFrame, path: str) -> None:
    """One folder per status: the open-order list reads three folders only.

    Rows are spread by date inside a status, so that a status with most of the
    orders is written by many tasks and in files of even size.
    """
    (
        orders.repartitionByRange("order_status", "order_date", "order_id")
        .sortWithinPartitions("order_status", "order_date")
        .write.partitionBy("order_status")
        .parquet(path)
    )


def write_orders_by_customer(orders: DataFrame, path: str) -> None:
    """Sorted by customer and date: footer statistics rule out most row groups.

    The date and id take part in the range split, so one customer with a large
    share of the orders covers several files instead of one.
    """
    (
        orders.repartitionByRange("customer_id", "order_date", "order_id")
        .sortWithinPartitions("customer_id", F.col("order_date"))
        .write.parquet(path)
    )


class UnevenBuckets(ValueError):
    """One bucket would hold far more rows than the others."""


def write_bucketed(
    df: DataFrame, key: str, buckets: int, path: str, *, order: Sequence[str] = (), max_factor: float = 8.0
) -> DataFrame:
    """Store ``df`` in ``buckets`` buckets by ``key`` and return the stored table.

    Tables with equal buckets on one key are joined and grouped by it without a
    shuffle, and a lookup of one key reads one bucket. Nothing can split the
    task of a bucket in such a join, so a table whose fullest bucket exceeds
    ``max_factor`` times the average (and that many thousand rows) is refused:
    a key with a hot value belongs in a sorted layout. ``order`` names columns
    that split a bucket among several writers, which then leaves several files.

    The table is an external one of the session's catalog under a name of its
    own; its files lie at ``path``, which must not exist.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    sizes = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    seen = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if (seen["most"] or 0) > max_factor * max((seen["rows"] or 0) / buckets, 1000):
        raise UnevenBuckets(f"a bucket of {key} holds {seen['most']} of {seen['rows']} rows; use a sorted layout")
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        df.repartitionByRange(bucket, *order or [key])
        .sortWithinPartitions(bucket, key, *order)
        .write.bucketBy(buckets, key)
        .sortBy(key, *order)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
