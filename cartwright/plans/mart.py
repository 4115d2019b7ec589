"""The monthly mart on disk: build, publish, refresh touched months.

A published mart is a ``PublishedTable`` with one part per calendar month: a
refresh writes files aside and then makes them the newest version by creating
one manifest. Readers see the old mart or the new one and never a mixture, on
object stores too. Months that a refresh does not touch keep their files.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions import month_start
from cartwright.plans.finance import monthly_mart
from cartwright.sources.published import ConcurrentRefresh, PublishedTable

__all__ = [
    "ConcurrentRefresh", "current_version", "mart_table", "prune_mart", "publish", "publish_mart", "read_mart",
    "refresh_mart", "refresh_mart_incremental", "write_mart",
]


def write_mart(mart: DataFrame, path: str) -> None:
    """Store a mart, replacing what is at ``path``. One row per month: one file."""
    mart.repartition(1).write.mode("overwrite").parquet(path)


def mart_table(spark: SparkSession, root: str) -> PublishedTable:
    return PublishedTable(spark, root, "sales_month")


def current_version(spark: SparkSession, root: str) -> int | None:
    """Newest published version, or None before the first one."""
    return max(mart_table(spark, root).versions(), default=None)


def read_mart(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The published mart; an older ``version`` can be read until it is pruned."""
    return mart_table(spark, root).read(version)


def publish(spark: SparkSession, mart: DataFrame, root: str, base: int | None = None) -> int:
    """Write ``mart`` as the next version, check that months are unique, and switch readers to it.

    ``base`` is the version that the mart was made from (by default the newest
    one now); if another one has been published since, this one is refused.
    """
    return mart_table(spark, root).replace(mart, base=base, unique=True)


def publish_mart(spark: SparkSession, orders: DataFrame, items: DataFrame, root: str) -> int:
    """Rebuild the whole mart and switch readers to it."""
    return publish(spark, monthly_mart(orders, items), root, current_version(spark, root) or 0)


refresh_mart = publish_mart


def prune_mart(spark: SparkSession, root: str, *, keep: int = 2) -> int:
    """Delete all versions but the newest ``keep``; returns how many."""
    return mart_table(spark, root).prune(keep=keep)


def refresh_mart_incremental(
    spark: SparkSession,
    orders: DataFrame,
    items: DataFrame,
    changed_orders: DataFrame,
    root: str,
) -> list[datetime.date]:
    """Recompute and rewrite only the months that ``changed_orders`` touch.

    Pass old and new images of an order whose date moved. Distinct buyers do
    not add up, so a touched month is computed again from all its orders; the
    date bounds reach the scan of orders. Other months are neither read nor
    written, and refreshes of other months may run at the same time. Returns
    the months, which are bounded by the calendar.
    """
    touched = [
        row[0]
        for row in changed_orders.select(month_start(F.col("order_date")))
        .distinct()
        .dropna()
        .collect()
    ]
    if not touched:
        return []
    table = mart_table(spark, root)
    base = table.manifest()
    if base is None:
        raise FileNotFoundError(f"no mart was published at {root}")
    kind = orders.schema["order_date"].dataType
    last = max(touched)
    after = (last.replace(day=1) + datetime.timedelta(days=32)).replace(day=1)
    when = F.col("order_date")
    affected = orders.filter(
        (when >= F.lit(min(touched)).cast(kind))
        & (when < F.lit(after).cast(kind))
        & month_start(when).isin(touched)
    )
    # Lines of other months are dropped before they are summed per order.
    lines = items.join(affected.select("order_id"), "order_id", "left_semi")
    table.replace_parts(monthly_mart(affected, lines), touched, base=base, unique=True)
    return sorted(touched)
