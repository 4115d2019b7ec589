"""Printed form of the reports: money, percentages and months as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import fixed, join_text, money, percent
from cartwright.functions import labels as L


def _loose_percent(name: str, digits: int = 2) -> Column:
    """Text of a percentage where a missing number leaves just the sign."""
    return join_text(fixed(F.col(name), digits), F.lit("%"))


def print_monthly_kpis(kpis: DataFrame) -> DataFrame:
    growth = F.col("mom_net_revenue_growth_pct")
    return kpis.select(
        F.date_format("sales_month", "yyyy-MM").alias("month_label"),
        "total_orders",
        "active_customers",
        money(F.col("gross_merchandise_value")).alias("gmv"),
        money(F.col("total_discounts")).alias("discounts"),
        money(F.col("net_revenue")).alias("net_revenue"),
        money(F.col("gross_profit")).alias("gross_profit"),
        _loose_percent("gross_margin_pct").alias("gross_margin"),
        money(F.col("average_order_value")).alias("aov"),
        F.when(growth.isNull(), L.BASE_MONTH)
        .otherwise(_loose_percent("mom_net_revenue_growth_pct"))
        .alias("mom_growth"),
    )


def print_channel_performance(channels: DataFrame) -> DataFrame:
    return channels.withColumns(
        {
            "total_attributed_revenue": money(F.col("total_attributed_revenue")),
            "revenue_per_acquired_customer": money(F.col("revenue_per_acquired_customer")),
        }
    )


def print_rfm_segments(segments: DataFrame) -> DataFrame:
    return segments.withColumns(
        {
            "avg_customer_spend": money(F.col("avg_customer_spend")),
            "total_segment_revenue": money(F.col("total_segment_revenue")),
        }
    )


def print_cohort_matrix(matrix: DataFrame) -> DataFrame:
    shares = [c for c in matrix.columns if c.endswith("_retention")]
    return matrix.select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"),
        "cohort_size",
        "m0_users",
        *[percent(F.col(c), 1).alias(c) for c in shares],
    )


def print_product_pareto(pareto: DataFrame) -> DataFrame:
    return pareto.select(
        "revenue_rank",
        "product_name",
        "category_name",
        "total_units_sold",
        money(F.col("total_revenue")).alias("revenue"),
        money(F.col("total_gross_profit")).alias("profit"),
        _loose_percent("margin_pct").alias("margin"),
        _loose_percent("cumulative_revenue_pct").alias("cumulative_share"),
        "pareto_classification",
    )


def print_delivery_sla(sla: DataFrame) -> DataFrame:
    return sla.withColumns(
        {
            "on_time_sla_pct": percent(F.col("on_time_sla_pct"), 1),
            "avg_shipping_fee_collected": money(F.col("avg_shipping_fee_collected")),
        }
    )


def print_status_pipeline(pipeline: DataFrame) -> DataFrame:
    return pipeline.withColumn("total_pipeline_value", money(F.col("total_pipeline_value")))


def print_payment_health(health: DataFrame) -> DataFrame:
    return health.withColumns(
        {
            "gateway_success_rate": percent(F.col("gateway_success_rate")),
            "total_processed_volume": money(F.col("total_processed_volume")),
            "total_refund_leakage": money(F.col("total_refund_leakage")),
        }
    )


def print_return_vs_rating(returns: DataFrame) -> DataFrame:
    return returns.withColumn("return_rate_pct", percent(F.col("return_rate_pct")))
