"""Recency, frequency and monetary segmentation."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import join_text, not_cancelled, pct, ratio, whole_days
from cartwright.functions import labels as L
from cartwright.operators.ranking import distributed_ntile
from cartwright.runtime import materialize


def _purchases(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(not_cancelled())
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order"),
            F.count("*").alias("frequency"),
            F.sum("total_amount").alias("monetary_value"),
        )
    )


def _tiles(measured: DataFrame, n_tiles: int, orders: dict[str, list[Column]]) -> DataFrame:
    """Add NTILE columns; ``measured`` has at most one row per customer."""
    return distributed_ntile(materialize(measured, "rfm"), n_tiles, orders, "customer_id")


def rfm_scores(customers: DataFrame, orders: DataFrame, n_tiles: int = 5) -> DataFrame:
    """Scores and segment of every customer with a non-cancelled order.

    Recency counts whole days up to the newest order of any status. Scores
    grow with how good the customer is; customer ids break ties.
    """
    newest = orders.agg(F.max("order_date")).scalar()
    measured = (
        customers.select(
            "customer_id",
            join_text(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
            "email",
            "acquisition_channel",
        )
        .join(_purchases(orders), "customer_id")
        .withColumn("recency_days", whole_days(F.col("last_order"), newest))
        .drop("last_order")
    )
    scored = _tiles(
        measured,
        n_tiles,
        {
            "r_score": [-F.col("recency_days")],
            "f_score": [F.col("frequency")],
            "m_score": [F.col("monetary_value")],
        },
    )
    named = scored.withColumnsRenamed({"r_score": "r", "f_score": "f", "m_score": "m"})
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    return named.select(
        "customer_id",
        "customer_name",
        "email",
        "acquisition_channel",
        "recency_days",
        "frequency",
        "monetary_value",
        r.alias("r_score"),
        f.alias("f_score"),
        m.alias("m_score"),
        join_text(r, f, m).alias("rfm_combined"),
        F.round((r + f + m).cast("double") / 3.0, 2).alias("rfm_avg"),
        F.expr(L.segment_case()).alias("customer_segment"),
    )


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Size, averages and revenue of each segment. Shares are taken over the
    segment rows, nine at most."""
    whole = Window.partitionBy()
    return (
        scores.groupBy("customer_segment")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.sum("recency_days").alias("__recency"),
            F.sum("frequency").alias("__orders"),
            F.sum("monetary_value").alias("total_segment_revenue"),
        )
        .select(
            "customer_segment",
            "customer_count",
            pct(F.col("customer_count"), F.sum("customer_count").over(whole)).alias(
                "pct_of_customer_base"
            ),
            _mean("__recency", 1).alias("avg_recency_days"),
            _mean("__orders", 2).alias("avg_orders_per_customer"),
            _mean("total_segment_revenue", 2).alias("avg_customer_spend"),
            "total_segment_revenue",
            pct(
                F.col("total_segment_revenue"), F.sum("total_segment_revenue").over(whole)
            ).alias("pct_of_total_revenue"),
        )
        .orderBy(F.col("total_segment_revenue").desc_nulls_first())
    )


def _mean(total: str, digits: int) -> Column:
    return F.round(ratio(F.col(total), F.col("customer_count")), digits)


def revenue_at_risk(segments: DataFrame) -> DataFrame:
    """Customers and revenue of the core buyers and of those about to leave."""
    name = F.col("customer_segment")
    group = (
        F.when(name.isin(L.CHAMPIONS, L.LOYAL), "core")
        .when(name.isin(L.AT_RISK, L.NEED_ATTENTION), "at_risk")
        .otherwise("other")
    )
    whole = Window.partitionBy()
    return (
        segments.groupBy(group.alias("revenue_group"))
        .agg(
            F.sum("customer_count").alias("customers"),
            F.sum("total_segment_revenue").alias("revenue"),
        )
        .select(
            "revenue_group",
            "customers",
            "revenue",
            pct(F.col("customers"), F.sum("customers").over(whole)).alias("pct_of_customers"),
            pct(F.col("revenue"), F.sum("revenue").over(whole)).alias("pct_of_revenue"),
        )
    )


def rfm_score_cells(
    customers: DataFrame, orders: DataFrame, as_of: datetime.date, n: int = 15
) -> DataFrame:
    """Customers and average spend per score cell, over all customers.

    Here 1 is the best tile; customers without orders come last by recency.
    Days count from ``as_of`` and are negative for later orders.
    """
    zero = F.lit(0).cast("decimal(12,2)")
    measured = (
        customers.select("customer_id")
        .join(_purchases(orders), "customer_id", "left")
        .select(
            "customer_id",
            F.datediff(F.lit(as_of), F.col("last_order").cast("date")).alias("recency_days"),
            F.coalesce("frequency", F.lit(0)).alias("frequency"),
            F.coalesce("monetary_value", zero).alias("monetary_value"),
        )
    )
    never = F.col("recency_days").isNull().cast("int")
    scored = _tiles(
        measured,
        5,
        {
            "r_score": [never, F.coalesce("recency_days", F.lit(0))],
            "f_score": [-F.col("frequency")],
            "m_score": [-F.col("monetary_value")],
        },
    )
    return (
        scored.groupBy("r_score", "f_score", "m_score")
        .agg(
            F.count("*").alias("total_customers"),
            F.sum("monetary_value").alias("__spend"),
        )
        .withColumn(
            "avg_segment_spend",
            F.round(ratio(F.col("__spend"), F.col("total_customers")), 2),
        )
        .drop("__spend")
        .orderBy(
            F.col("r_score").desc_nulls_first(),
            F.col("f_score").desc_nulls_first(),
            F.col("m_score").desc_nulls_first(),
        )
        .limit(n)
    )
