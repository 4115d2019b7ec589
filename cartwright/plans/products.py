"""Product revenue, Pareto tiers, returns against ratings, catalogue lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions import labels as L
from cartwright.functions import amount, cents, not_cancelled, pct
from cartwright.operators.ranking import distributed_running_sum
from cartwright.runtime import materialize


def product_sales(
    products: DataFrame, categories: DataFrame, items: DataFrame, orders: DataFrame
) -> DataFrame:
    """Units, revenue and profit per product over non-cancelled orders.

    Lines meet their order in a semi join (a lookup of the id, nothing else is
    read from orders) and are summed per product before product and category
    names are attached, so the dimension joins see one row per product.
    """
    live = orders.filter(not_cancelled()).select("order_id")
    revenue = cents(items, "total_price")
    cost = F.col("quantity") * cents(items, "cost_price")
    sold = (
        items.join(live, "order_id", "left_semi")
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            amount(F.sum(revenue)).alias("total_revenue"),
            amount(F.sum(revenue - cost)).alias("total_gross_profit"),
        )
    )
    return (
        products.select(
            "product_id",
            "category_id",
            "product_name",
            "sku",
            F.col("stock_quantity").alias("current_inventory"),
        )
        .join(sold, "product_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .drop("category_id")
        .withColumn("margin_pct", pct(F.col("total_gross_profit"), F.col("total_revenue")))
    )


def _with_running_share(sales: DataFrame) -> DataFrame:
    names = {"running": "cumulative_revenue", "total": "overall_revenue", "rank": "revenue_rank"}
    stored = materialize(sales, "product-sales")
    ranked = distributed_running_sum(stored, "total_revenue", "total_revenue", **names)
    return ranked.withColumn(
        "cumulative_revenue_pct", pct(F.col("cumulative_revenue"), F.col("overall_revenue"))
    )


def product_pareto(
    products: DataFrame, categories: DataFrame, items: DataFrame, orders: DataFrame
) -> DataFrame:
    """Products by revenue with running share, rank and tier; equals share a rank."""
    share = F.col("cumulative_revenue_pct")
    tier = (
        F.when(share <= L.TIER_A[0], L.TIER_A[1])
        .when(share <= L.TIER_B[0], L.TIER_B[1])
        .otherwise(L.TIER_C)
    )
    sales = product_sales(products, categories, items, orders)
    return (
        _with_running_share(sales)
        .select(
            "revenue_rank",
            "product_id",
            "product_name",
            "sku",
            "category_name",
            "current_inventory",
            "total_units_sold",
            "total_revenue",
            "total_gross_profit",
            "margin_pct",
            "cumulative_revenue",
            "overall_revenue",
            "cumulative_revenue_pct",
            tier.alias("pareto_classification"),
        )
        .orderBy("revenue_rank", "product_id")
    )


def pareto_tier_summary(pareto: DataFrame) -> DataFrame:
    """Products and revenue per tier, shares over the (three) tier rows."""
    whole = Window.partitionBy()
    return (
        pareto.groupBy("pareto_classification")
        .agg(F.count("*").alias("products"), F.sum("total_revenue").alias("revenue"))
        .select(
            "pareto_classification",
            "products",
            pct(F.col("products"), F.sum("products").over(whole), 1).alias("pct_of_catalog"),
            "revenue",
            pct(F.col("revenue"), F.sum("revenue").over(whole)).alias("pct_of_revenue"),
        )
        .orderBy("pareto_classification")
    )


def pareto_top(
    products: DataFrame,
    categories: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    n: int = 10,
) -> DataFrame:
    """The ``n`` products with the most revenue and their running share.

    No product beyond the report is numbered. A product's running sum is that
    of the revenue levels down to its own, and ``n`` products stand on the
    ``n`` highest levels at most; a level counts all products that tie on it,
    those that the report leaves out as well.
    """
    sales = materialize(product_sales(products, categories, items, orders), "product-sales")
    highest = F.col("total_revenue").desc_nulls_first()
    top = sales.orderBy(highest, "product_id").limit(n)
    levels = (
        sales.groupBy("total_revenue")
        .agg(F.sum("total_revenue").alias("__level"))
        .orderBy(highest)
        .limit(n)
    )
    # A window over the n level rows, not over products.
    down_to = Window.orderBy(highest).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = levels.select(
        F.col("total_revenue").alias("__revenue"),
        F.sum("__level").over(down_to).alias("cumulative_revenue"),
    )
    overall = sales.agg(F.sum("total_revenue")).scalar()
    return (
        top.join(shares, F.col("total_revenue").eqNullSafe(F.col("__revenue")))
        .withColumn("cumulative_revenue_pct", pct(F.col("cumulative_revenue"), overall))
        .orderBy(highest, "product_id")
        .select(
            "product_id",
            "product_name",
            "category_name",
            "total_units_sold",
            "total_revenue",
            "total_gross_profit",
            "cumulative_revenue",
            "cumulative_revenue_pct",
        )
    )


def product_return_vs_rating(
    products: DataFrame,
    categories: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    min_orders: int = 15,
    n: int = 15,
) -> DataFrame:
    """Products with the highest return rate, next to their reviews.

    Cancelled orders count here. Lines collapse to distinct (order, product)
    pairs before they meet the orders, so an order holds at most one row per
    product and the distinct order counts become plain counts.
    """
    pairs = items.select("order_id", "product_id").distinct()
    returned = F.col("order_status") == "returned"
    ordered = (
        pairs.join(orders.select("order_id", "order_status"), "order_id")
        .groupBy("product_id")
        .agg(
            F.count("*").alias("total_orders_containing_product"),
            F.count_if(returned).alias("returned_orders_count"),
        )
        .filter(F.col("total_orders_containing_product") >= min_orders)
    )
    rated = reviews.groupBy("product_id").agg(
        F.count("review_id").alias("total_reviews"),
        F.round(F.sum("rating").cast("double") / F.count("rating"), 2).alias("avg_rating"),
    )
    stars = F.col("avg_rating")
    flag = (
        F.when(stars >= L.RATED_HIGH[0], L.RATED_HIGH[1])
        .when(stars >= L.RATED_FAIR[0], L.RATED_FAIR[1])
        .otherwise(L.RATED_LOW)
    )
    returns, total = F.col("returned_orders_count"), F.col("total_orders_containing_product")
    return (
        products.select("product_id", "product_name", "category_id")
        .join(ordered, "product_id")
        .join(categories.select("category_id", "category_name"), "category_id")
        .join(rated, "product_id", "left")
        .withColumns(
            {
                "total_reviews": F.coalesce("total_reviews", F.lit(0)),
                "avg_rating": F.coalesce("avg_rating", F.lit(0.0)),
                "__rate": returns.cast("double") / total,
            }
        )
        .orderBy(F.col("__rate").desc_nulls_first(), "product_id")
        .select(
            "product_id",
            "product_name",
            "category_name",
            "total_orders_containing_product",
            "returned_orders_count",
            pct(returns, total).alias("return_rate_pct"),
            "total_reviews",
            "avg_rating",
            flag.alias("satisfaction_flag"),
        )
        .limit(n)
    )


def catalog_search(products: DataFrame, needle: str) -> DataFrame:
    """Products whose name contains ``needle`` in any case, dearest first."""
    literal = needle.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return (
        products.filter(F.col("product_name").ilike(f"%{literal}%"))
        .select("product_id", "product_name", "sku", "sale_price")
        .orderBy(F.col("sale_price").desc_nulls_first(), "product_id")
    )


def low_stock_products(products: DataFrame, threshold: int = 15) -> DataFrame:
    """Active products with less stock than ``threshold``."""
    return products.filter(F.col("is_active") & (F.col("stock_quantity") < threshold)).select(
        "product_id", "product_name", "sku", "stock_quantity"
    )
