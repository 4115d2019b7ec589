"""Payment methods: outcomes, volume and refunds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import pct


def _by_method(payments: DataFrame) -> DataFrame:
    status = F.col("payment_status")
    zero = F.lit(0).cast(payments.schema["amount"].dataType)
    return payments.groupBy("payment_method").agg(
        F.count("*").alias("total_transactions"),
        F.count_if(status == "completed").alias("successful_payments"),
        F.count_if(status == "refunded").alias("refunded_payments"),
        F.count_if(status == "failed").alias("failed_payments"),
        F.sum("amount").alias("total_processed_volume"),
        F.sum(F.when(status == "refunded", F.col("amount")).otherwise(zero)).alias(
            "total_refund_leakage"
        ),
    )


def payment_method_health(payments: DataFrame) -> DataFrame:
    """Outcomes per method. Pending payments count in the total and the volume only."""
    return (
        _by_method(payments)
        .withColumn(
            "gateway_success_rate", pct(F.col("successful_payments"), F.col("total_transactions"))
        )
        .orderBy(F.col("total_transactions").desc_nulls_first(), "payment_method")
    )


def payment_method_share(payments: DataFrame) -> DataFrame:
    """Share of all payments and failure rate per method."""
    everything = F.sum("total_transactions").over(Window.partitionBy())
    return (
        _by_method(payments)
        .select(
            "payment_method",
            "total_transactions",
            pct(F.col("total_transactions"), everything).alias("pct_of_transactions"),
            pct(F.col("failed_payments"), F.col("total_transactions")).alias("failure_rate_pct"),
        )
        .orderBy(F.col("total_transactions").desc_nulls_first(), "payment_method")
    )
