"""Monthly purchase cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import month_distance, month_start, not_cancelled, pct


def cohort_retention_long(orders: DataFrame) -> DataFrame:
    """Active customers per cohort month and month index.

    Orders collapse to distinct (customer, month) pairs before the shuffle, so
    a customer holds at most one row per calendar month however many orders
    there are. The cohort month is the minimum of those rows, and counting
    them replaces distinct counts. A cohort's size is its month-0 row, since
    every customer is active in the first month.
    """
    months = (
        orders.filter(not_cancelled() & F.col("customer_id").isNotNull())
        .select("customer_id", month_start(F.col("order_date")).alias("order_month"))
        .distinct()
    )
    first = F.min("order_month").over(Window.partitionBy("customer_id"))
    active = (
        months.withColumn("cohort_month", first)
        .groupBy(
            "cohort_month",
            month_distance(F.col("cohort_month"), F.col("order_month")).alias("month_number"),
        )
        .agg(F.count("*").alias("active_users"))
    )
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_users"))).over(
        Window.partitionBy("cohort_month")
    )
    return active.select("cohort_month", size.alias("cohort_size"), "month_number", "active_users")


def cohort_retention_matrix(long: DataFrame, max_month: int = 6) -> DataFrame:
    """One row per cohort: users in month 0, then retention in percent.

    A month without activity shows 0, also when it lies in the future.
    """

    def users(month: int):
        return F.max(F.when(F.col("month_number") == month, F.col("active_users")))

    later = range(1, max_month + 1)
    wide = long.groupBy("cohort_month", "cohort_size").agg(
        users(0).alias("m0_users"),
        *[F.coalesce(users(m), F.lit(0)).alias(f"m{m}") for m in later],
    )
    return wide.select(
        "cohort_month",
        "cohort_size",
        "m0_users",
        *[pct(F.col(f"m{m}"), F.col("cohort_size"), 1).alias(f"m{m}_retention") for m in later],
    ).orderBy(F.col("cohort_month").asc_nulls_last())


def retention_curve(long: DataFrame, censor: bool = True) -> DataFrame:
    """Mean retention per month index over cohorts.

    With ``censor`` a cohort takes part only in months that its data covers;
    otherwise months still to come count as 0. Works on one row per cohort,
    each with its activity by month (bounded by the calendar).
    """
    last_month = F.max(F.expr("add_months(cohort_month, month_number)"))
    cohorts = (
        long.groupBy("cohort_month", "cohort_size")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("month_number", "active_users"))
            ).alias("users"),
            last_month.alias("last_seen"),
            F.max("month_number").alias("last_number"),
        )
        .withColumns(
            {
                "covered": month_distance(
                    F.col("cohort_month"), F.max("last_seen").over(Window.partitionBy())
                ),
                "longest": F.max("last_number").over(Window.partitionBy()),
            }
        )
    )
    upto = F.col("covered") if censor else F.col("longest")
    return (
        cohorts.withColumn("month_number", F.explode(F.sequence(F.lit(0), upto)))
        .withColumn(
            "share",
            F.coalesce(F.try_element_at("users", F.col("month_number")), F.lit(0)).cast("double")
            / F.col("cohort_size"),
        )
        .groupBy("month_number")
        .agg(
            F.count("*").alias("cohorts"),
            F.round(F.avg("share") * 100, 2).alias("avg_retention_pct"),
        )
        .orderBy("month_number")
    )
