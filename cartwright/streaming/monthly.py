"""Monthly totals and distinct buyers kept up to date as orders arrive.

``monthly_stream`` keeps measures that add up in Spark's own state, one row per
calendar month, so no watermark has to drop late orders to bound it.

``monthly_buyers_stream`` adds distinct buyers, which do not add up as numbers
but do as sets: its state holds exact bitmaps of buyers, per month and bucket
of 32,768 customer ids, beside the sums of their orders. A micro-batch is
summed to the same form, joined with the stored rows of the months it touches,
and published in their place; no order is read again, however late another one
of its month arrives. The state is a published table, so a version, the batch
it ends with and all its months become visible at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwright.functions import amount, cents, month_start, not_cancelled
from cartwright.plans.mart import mart_table
from cartwright.sources.published import PublishedTable

#: Versions that are kept: one for readers that began before the newest was published.
KEPT_VERSIONS = 2
#: Buckets of a month that one task writes: 4 KB for each, before compression.
_BUCKETS_PER_FILE = 4096

_SUMS = {
    "subtotal_amount": "gross_merchandise_value",
    "discount_amount": "total_discounts",
    "shipping_fee": "total_shipping_revenue",
    "total_amount": "net_revenue",
}


def monthly_totals(orders: DataFrame) -> DataFrame:
    """Totals per month of non-cancelled orders; batch or streaming input."""
    return (
        orders.filter(not_cancelled())
        .groupBy(month_start(F.col("order_date")).alias("sales_month"))
        .agg(
            F.count("*").alias("total_orders"),
            *[F.sum(c).alias(name) for c, name in _SUMS.items()],
        )
    )


def monthly_stream(orders: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Publish a new version of the totals at ``root`` after every micro-batch.

    Updated months replace their old rows, other months keep their files. The
    rows are whole totals, not differences, so running a batch again gives the
    same table.
    """

    def upsert(updated: DataFrame, _batch_id: int) -> None:
        # One row per month, read three times below.
        fresh = updated.persist()
        try:
            months = [r[0] for r in fresh.select("sales_month").collect()]
            if months:
                table = mart_table(updated.sparkSession, root)
                table.replace_parts(fresh, months, base=table.manifest(), unique=True)
                table.prune(keep=KEPT_VERSIONS)
        finally:
            fresh.unpersist()

    return (
        monthly_totals(orders)
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# ------------------------------------------------------------ distinct buyers


def buyer_state(orders: DataFrame) -> DataFrame:
    """Per month and bucket of customer ids: a bitmap of the buyers, orders and sums in cents.

    Non-cancelled orders count, as in the totals. A bitmap takes 4 KB whatever
    its bucket holds, so ids should be whole numbers without very large gaps.
    Orders without a customer have a bucket of their own and no buyer.
    """
    buyer = F.col("customer_id").cast("bigint")
    sold = orders.filter(not_cancelled()).select(
        month_start(F.col("order_date")).alias("sales_month"),
        F.bitmap_bucket_number(buyer).alias("bucket"),
        F.bitmap_bit_position(buyer).alias("position"),
        *[cents(orders, c).alias(name) for c, name in _SUMS.items()],
    )
    return sold.groupBy("sales_month", "bucket").agg(
        F.bitmap_construct_agg("position").alias("buyers"),
        F.count("*").alias("total_orders"),
        *[F.sum(name).alias(name) for name in _SUMS.values()],
    )


def merge_buyer_states(*states: DataFrame) -> DataFrame:
    """States of different orders as one. The order of merging does not matter."""
    together = states[0]
    for state in states[1:]:
        together = together.unionByName(state)
    return together.groupBy("sales_month", "bucket").agg(
        F.bitmap_or_agg("buyers").alias("buyers"),
        F.sum("total_orders").alias("total_orders"),
        *[F.sum(name).alias(name) for name in _SUMS.values()],
    )


def monthly_buyers(state: DataFrame) -> DataFrame:
    """The totals of ``monthly_totals`` and ``unique_buyers`` per month."""
    return state.groupBy("sales_month").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum(F.bitmap_count("buyers")).alias("unique_buyers"),
        *[amount(F.sum(name)).alias(name) for name in _SUMS.values()],
    )


def buyers_table(spark: SparkSession, root: str) -> PublishedTable:
    return PublishedTable(spark, root, "sales_month")


def read_monthly_buyers(spark: SparkSession, root: str) -> DataFrame:
    """Totals and distinct buyers as of the newest finished micro-batch."""
    return monthly_buyers(buyers_table(spark, root).read())


def add_orders(spark: SparkSession, orders: DataFrame, root: str, *, source: str, batch: int) -> bool:
    """Add new orders to the state at ``root``; False if this batch of this source is in it already.

    The manifest says which batch of which source a version ends with, so a
    batch that is run again after a failure is not counted twice.
    """
    table = buyers_table(spark, root)
    base = table.manifest()
    done = dict(base.note) if base else {}
    if done.get(source, -1) >= batch:
        return False
    # Read for its months and again for its rows; of a bounded number of rows per bucket and month.
    fresh = buyer_state(orders).persist()
    try:
        months = [r[0] for r in fresh.select("sales_month").distinct().collect()]
        merged = merge_buyer_states(table.scan(base, parts=months), fresh) if base else fresh
        file = F.floor(F.coalesce("bucket", F.lit(0)) / _BUCKETS_PER_FILE)
        table.replace_parts(merged, months, base=base, note={**done, source: batch}, spread=[file])
    finally:
        fresh.unpersist()
    table.prune(keep=KEPT_VERSIONS)
    return True


def monthly_buyers_stream(orders: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the state at ``root`` up to date with a stream of orders; ``read_monthly_buyers`` reads it."""

    def add(batch: DataFrame, batch_id: int) -> None:
        add_orders(batch.sparkSession, batch, root, source=checkpoint, batch=batch_id)

    return (
        orders.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
