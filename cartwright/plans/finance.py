"""Monthly financial performance and acquisition channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import amount, cents, month_start, not_cancelled, pct, ratio


def line_totals(items: DataFrame) -> DataFrame:
    """Lines and cost per order: one row per order, combined before the shuffle."""
    return items.groupBy("order_id").agg(
        F.count("*").alias("n_lines"),
        F.sum(F.col("quantity") * cents(items, "cost_price")).alias("cogs_cents"),
    )


_AMOUNTS = {
    "subtotal_amount": "gross_merchandise_value",
    "discount_amount": "total_discounts",
    "shipping_fee": "total_shipping_revenue",
    "total_amount": "net_revenue",
}


def _monthly_sums(orders: DataFrame, items: DataFrame, *, per_line: bool) -> DataFrame:
    """Sums per month over non-cancelled orders that have lines.

    The published KPIs join orders to their lines and then sum order-level
    amounts, so an order with four lines counts its amount four times. With
    ``per_line`` that is reproduced as ``amount * n_lines`` on one row per
    order; without it each order counts once. Either way the join is one to
    one, and order ids being unique turns the distinct order count into a
    plain count. Amounts are summed as whole cents.
    """
    weight = F.col("n_lines") if per_line else F.lit(1)
    sold = (
        orders.filter(not_cancelled())
        .select(
            "order_id",
            "customer_id",
            month_start(F.col("order_date")).alias("sales_month"),
            *[cents(orders, c).alias(c) for c in _AMOUNTS],
        )
        .join(line_totals(items), "order_id")
    )
    return sold.groupBy("sales_month").agg(
        F.count("*").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_buyers"),
        *[amount(F.sum(F.col(c) * weight)).alias(name) for c, name in _AMOUNTS.items()],
        amount(F.sum("cogs_cents")).alias("total_cogs"),
    ).withColumn("gross_profit", F.col("net_revenue") - F.col("total_cogs"))


def _with_growth(monthly: DataFrame) -> DataFrame:
    """Margin, order value and growth over the previous observed month.

    The window runs over one row per calendar month.
    """
    previous = F.lag("net_revenue").over(Window.orderBy("sales_month"))
    return (
        monthly.withColumn("prev_month_net_revenue", previous)
        .select(
            "sales_month",
            "total_orders",
            F.col("unique_buyers").alias("active_customers"),
            "gross_merchandise_value",
            "total_discounts",
            "net_revenue",
            "total_cogs",
            "gross_profit",
            pct(F.col("gross_profit"), F.col("net_revenue")).alias("gross_margin_pct"),
            F.round(ratio(F.col("net_revenue"), F.col("total_orders")), 2).alias(
                "average_order_value"
            ),
            "prev_month_net_revenue",
            pct(
                F.col("net_revenue") - F.col("prev_month_net_revenue"),
                F.col("prev_month_net_revenue"),
            ).alias("mom_net_revenue_growth_pct"),
        )
        .orderBy(F.col("sales_month").desc_nulls_first())
    )


def monthly_kpis(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Monthly KPIs as published: order amounts counted once per order line."""
    return _with_growth(_monthly_sums(orders, items, per_line=True))


def monthly_kpis_order_grain(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Monthly KPIs with each order's amounts counted once."""
    return _with_growth(_monthly_sums(orders, items, per_line=False))


def monthly_mart(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of the monthly mart: the published sums plus shipping and order value."""
    return _monthly_sums(orders, items, per_line=True).select(
        "sales_month",
        "total_orders",
        "unique_buyers",
        "gross_merchandise_value",
        "total_discounts",
        "total_shipping_revenue",
        "net_revenue",
        "total_cogs",
        "gross_profit",
        pct(F.col("gross_profit"), F.col("net_revenue")).alias("gross_profit_margin_pct"),
        F.round(ratio(F.col("net_revenue"), F.col("total_orders")), 2).alias(
            "average_order_value"
        ),
    )


def mart_dashboard(mart: DataFrame) -> DataFrame:
    """Dashboard columns of the stored mart, newest month first."""
    return mart.select(
        "sales_month",
        "total_orders",
        F.col("unique_buyers").alias("active_customers"),
        "gross_merchandise_value",
        "net_revenue",
        "gross_profit",
        F.col("gross_profit_margin_pct").alias("gross_margin_pct"),
    ).orderBy(F.col("sales_month").desc_nulls_first())


def channel_performance(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, orders and revenue per acquisition channel.

    Orders are first summed per customer, so both sides of the join hold a
    customer once and a customer with very many orders costs one row. The share
    of all customers is taken over the finished channel rows.
    """
    spend = (
        orders.filter(not_cancelled())
        .groupBy("customer_id")
        .agg(F.count("*").alias("n_orders"), F.sum("total_amount").alias("spent"))
    )
    zero = F.lit(0).cast("decimal(12,2)")
    per_channel = (
        customers.select("customer_id", "acquisition_channel")
        .join(spend, "customer_id", "left")
        .groupBy("acquisition_channel")
        .agg(
            F.count("*").alias("acquired_customers"),
            F.coalesce(F.sum("n_orders"), F.lit(0)).alias("total_orders_placed"),
            F.coalesce(F.sum("spent"), zero).alias("total_attributed_revenue"),
        )
    )
    everyone = F.sum("acquired_customers").over(Window.partitionBy())
    return per_channel.withColumns(
        {
            "revenue_per_acquired_customer": F.round(
                ratio(F.col("total_attributed_revenue"), F.col("acquired_customers")), 2
            ),
            "channel_share_pct": pct(F.col("acquired_customers"), everyone),
        }
    ).orderBy(F.col("total_attributed_revenue").desc_nulls_first())
