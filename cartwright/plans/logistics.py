"""Delivery times, the order pipeline and order lookups."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwright.functions import amount, cents, interval_micros, moment, month_start, pct, pct_of_cents, ratio
from cartwright.functions import labels as L
from cartwright.functions.dates import MICROS_PER_DAY
from cartwright.operators import sketches
from cartwright.operators.percentiles import distributed_percentiles
from cartwright.runtime import materialize, temporary_tables
from cartwright.sources.published import PublishedTable

_PERCENTILES = {
    "fastest_delivery_days": 0.0,
    "median_delivery_days": 0.50,
    "p90_delivery_days": 0.90,
    "slowest_delivery_days": 1.0,
}


def _deliveries(orders: DataFrame) -> DataFrame:
    micros = interval_micros(F.col("order_date"), F.col("delivery_date"))
    return orders.filter(
        (F.col("order_status") == "delivered") & F.col("delivery_date").isNotNull()
    ).withColumns({"transit_micros": micros, "transit_days": micros / float(MICROS_PER_DAY)})


def _sla(deliveries: DataFrame, group: str, sla_days: float) -> DataFrame:
    """Delivery statistics per ``group`` from one read of the deliveries.

    The slowest and the fastest delivery are the percentiles 1 and 0, and all
    sums ride on the value counts that the percentiles need.
    """
    within = F.col("transit_days") <= sla_days
    sums = {
        "total_deliveries": F.col("order_id").isNotNull().cast("bigint"),
        "__micros": F.col("transit_micros").cast("decimal(20,0)"),
        "__on_time": F.when(within, 1).otherwise(0),
        "__fees": F.col("shipping_fee"),
        "__fee_rows": F.col("shipping_fee").isNotNull().cast("bigint"),
    }
    stats = distributed_percentiles(deliveries, group, "transit_days", _PERCENTILES, sums)
    return stats.select(
        group,
        "total_deliveries",
        F.round(
            F.col("__micros").cast("double") / F.col("total_deliveries") / float(MICROS_PER_DAY), 2
        ).alias("avg_delivery_days"),
        F.round("fastest_delivery_days", 1).alias("fastest_delivery_days"),
        F.round("slowest_delivery_days", 1).alias("slowest_delivery_days"),
        F.round("median_delivery_days", 2).alias("median_delivery_days"),
        F.round("p90_delivery_days", 2).alias("p90_delivery_days"),
        pct(F.col("__on_time"), F.col("total_deliveries"), 1).alias("on_time_sla_pct"),
        F.round(ratio(F.col("__fees"), F.col("__fee_rows")), 2).alias(
            "avg_shipping_fee_collected"
        ),
    )


def delivery_sla_by_state(orders: DataFrame, sla_days: float = 4, min_n: int = 20) -> DataFrame:
    """Delivery times per state with at least ``min_n`` deliveries, fastest first."""
    return (
        _sla(_deliveries(orders), "shipping_state", sla_days)
        .filter(F.col("total_deliveries") >= min_n)
        .orderBy(F.col("avg_delivery_days").asc_nulls_last(), "shipping_state")
    )


def delivery_sla_national(orders: DataFrame, sla_days: float = 4) -> DataFrame:
    """The same statistics over all deliveries."""
    everywhere = _deliveries(orders).withColumn("region", F.lit("national"))
    return _sla(everywhere, "region", sla_days)


# Percentiles that a stored sketch answers.
SKETCHED = {"median_delivery_days": 0.50, "p90_delivery_days": 0.90}


def delivery_sketches(orders: DataFrame, size: int = sketches.SIZE) -> DataFrame:
    """One sketch of delivery times per state and month of the order."""
    known = _deliveries(orders).withColumn("order_month", month_start(F.col("order_date")))
    return sketches.sketch_values(known, ["shipping_state", "order_month"], "transit_days", size)


def add_deliveries(spark: SparkSession, new_orders: DataFrame, root: str, size: int = sketches.SIZE) -> int:
    """Merge orders that have been delivered since into the sketches published at ``root``.

    Each delivery must be added once. Only the sketches of the months that the
    new orders belong to are read and replaced; no order that was added before
    is read again. Returns the version that readers see from now on.
    """
    table = PublishedTable(spark, root, "order_month")
    base = table.manifest()
    with temporary_tables(spark):
        new = materialize(delivery_sketches(new_orders, size), "delivery-sketches")
        # Months, which are bounded by the calendar.
        months = [row[0] for row in new.select("order_month").distinct().collect()]
        if base is not None:
            new = new.unionByName(table.scan(base, parts=months))
        merged = sketches.merge_sketches(new, ["shipping_state", "order_month"], size)
        return table.replace_parts(merged, months, base=base)


def delivery_percentiles(
    spark: SparkSession, root: str, since: datetime.date | None = None, until: datetime.date | None = None
) -> DataFrame:
    """Deliveries and delivery-time percentiles per state from the published sketches.

    ``since`` and ``until`` bound the months, both included. The true ranks are
    within ``sketches.rank_error`` of the stated ones.
    """
    stored = PublishedTable(spark, root, "order_month").read()
    if since is not None:
        stored = stored.filter(F.col("order_month") >= F.lit(since))
    if until is not None:
        stored = stored.filter(F.col("order_month") <= F.lit(until))
    return sketches.read_percentiles(sketches.merge_sketches(stored, ["shipping_state"]), SKETCHED)


def delivery_percentile_misses(orders: DataFrame, percentiles: DataFrame) -> DataFrame:
    """Deliveries per state and whether each sketched percentile keeps the stated error."""
    misses = sketches.rank_misses(
        _deliveries(orders), "shipping_state", "transit_days", percentiles, SKETCHED
    )
    kept = [(F.col(name) <= sketches.rank_error()).alias(f"{name}_kept") for name in SKETCHED]
    return misses.select("shipping_state", F.col("rows").alias("total_deliveries"), *kept)


def order_status_pipeline(orders: DataFrame) -> DataFrame:
    """Orders and value per status; the share is taken over the status rows."""
    everything = F.sum("order_count").over(Window.partitionBy())
    return (
        orders.groupBy("order_status")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("total_amount").alias("total_pipeline_value"),
        )
        .select(
            "order_status",
            "order_count",
            pct(F.col("order_count"), everything).alias("pct_of_total_orders"),
            "total_pipeline_value",
        )
        .orderBy(F.col("order_count").desc_nulls_first())
    )


def active_orders(orders: DataFrame) -> DataFrame:
    """Open orders, newest first. On the by-status layout closed ones are not read."""
    return (
        orders.filter(F.col("order_status").isin(L.OPEN_STATUSES))
        .select("order_id", "order_date", "customer_id", "total_amount")
        .orderBy(F.col("order_date").desc_nulls_first(), "order_id")
    )


def customer_timeline(
    orders: DataFrame, customer_id: int, since: datetime.datetime
) -> DataFrame:
    """One customer's orders since a date, newest first."""
    start = moment(since, orders.schema["order_date"].dataType)
    return (
        orders.filter((F.col("customer_id") == customer_id) & (F.col("order_date") >= start))
        .select("order_id", "customer_id", "order_date", "total_amount", "order_status")
        .orderBy(F.col("order_date").desc_nulls_first(), "order_id")
    )


def order_details(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """Every order line with customer, product, profit and margin.

    Products take their category and customers the orders before they meet the
    (larger) lines. Lines meet the products first: what a product adds is a
    third of what an order and its customer add, so the shuffle between the two
    joins carries less. No side is forced into a broadcast: Spark does that
    when its size is known to be small, and splits the partitions of a hot
    customer or product otherwise.
    """
    headers = orders.select("order_id", "order_date", "order_status", "customer_id").join(
        customers.select(
            "customer_id",
            F.concat_ws(" ", "first_name", "last_name").alias("customer_name"),
            F.col("email").alias("customer_email"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
            "acquisition_channel",
        ),
        "customer_id",
    )
    catalogue = products.select("product_id", "product_name", "category_id").join(
        categories.select("category_id", "category_name"), "category_id"
    )
    revenue = cents(items, "total_price")
    profit = revenue - F.col("quantity") * cents(items, "cost_price")
    return (
        items.join(catalogue, "product_id")
        .join(headers, "order_id")
        .select(
            "order_id",
            "order_date",
            "order_status",
            "customer_id",
            "customer_name",
            "customer_email",
            "customer_city",
            "customer_state",
            "acquisition_channel",
            "product_id",
            "product_name",
            "category_name",
            "quantity",
            "unit_price",
            "cost_price",
            "item_discount",
            F.col("total_price").alias("item_revenue"),
            amount(profit).alias("item_gross_profit"),
            pct_of_cents(profit, revenue).alias("item_margin_pct"),
        )
    )
