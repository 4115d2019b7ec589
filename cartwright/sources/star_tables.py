"""The seven retail tables as views over the TPC-H-like Parquet files.

Only columns that a caller selects are read. Derived values use integer and
decimal arithmetic on keys and prices, so any SQL engine reproduces them; the
mapping is written out in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: columns of the test files that the views read
FILE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}

# Arrival order of lines: the test data has no line id, so all columns decide
# and rows that tie on all of them are interchangeable.
LINE_ARRIVAL = (
    "created_at", "order_id", "line_number", "quantity", "unit_price", "item_discount",
)

_STATUS = """CASE
    WHEN o_orderkey % 20 = 0 THEN 'cancelled'
    WHEN o_orderkey % 20 = 1 THEN 'returned'
    WHEN o_orderstatus = 'F' THEN 'delivered'
    WHEN o_orderstatus = 'O' THEN 'shipped'
    WHEN o_orderkey % 2 = 0 THEN 'pending'
    ELSE 'processing' END"""

_DELIVERY_HOURS = """CASE order_status
    WHEN 'delivered' THEN 48 + (order_id * 7919) % 120
    WHEN 'returned' THEN 72 + (order_id * 31) % 48 END"""

_DISCOUNT_CENTS = """CASE WHEN o_orderkey % 12 = 0
    THEN (floor(o_totalprice * 100 + 0.5D) + 5) div 10 ELSE 0 END"""

_PAYMENT_STATUS = """CASE order_status
    WHEN 'pending' THEN 'pending'
    WHEN 'returned' THEN 'refunded'
    WHEN 'cancelled' THEN CASE WHEN (order_id div 20) % 10 < 7 THEN 'refunded' ELSE 'failed' END
    ELSE 'completed' END"""


def _amount(cents: str) -> str:
    """SQL for whole cents as an exact amount; stays within 18 digits."""
    return f"CAST(CAST({cents} AS DECIMAL(14,0)) * 0.01BD AS DECIMAL(12,2))"


class StarTables:
    """Canonical views of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(FILE_SCHEMAS[name]).parquet(path)

    def orders(self, *, with_state: bool = False) -> DataFrame:
        source = self.raw("orders")
        keyed = source.selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "o_orderdate AS order_date",
            f"{_STATUS} AS order_status",
            f"{_amount('floor(o_totalprice * 100 + 0.5D)')} AS subtotal_amount",
            "CAST(CAST(o_orderkey % 10 AS INT) AS DECIMAL(12,2)) AS shipping_fee",
            f"{_amount(_DISCOUNT_CENTS)} AS discount_amount",
            "o_orderpriority",
        )
        orders = keyed.selectExpr(
            "order_id",
            "customer_id",
            "order_date",
            "order_status",
            "subtotal_amount",
            "shipping_fee",
            "discount_amount",
            "CAST(subtotal_amount - discount_amount + shipping_fee AS DECIMAL(12,2)) AS total_amount",
            f"order_date + make_dt_interval(0, CAST({_DELIVERY_HOURS} AS INT)) AS delivery_date",
            "o_orderpriority AS order_priority",
        )
        if not with_state:
            return orders
        places = self.customers(with_state=True).select(
            "customer_id",
            F.col("city").alias("shipping_city"),
            F.col("state").alias("shipping_state"),
        )
        return orders.join(places, "customer_id")

    def order_items(self) -> DataFrame:
        # Amounts are whole cents in 64-bit integers until the last step.
        cents = self.raw("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "l_linenumber AS line_number",
            "l_shipdate AS created_at",
            "CAST(l_quantity AS BIGINT) AS quantity",
            "floor(l_extendedprice * 100 + 0.5D) div CAST(l_quantity AS BIGINT) AS unit_cents",
            "floor(l_discount * 100 + 0.5D) AS discount_pct",
        )
        lines = cents.selectExpr(
            "*",
            "(unit_cents * (50 + product_id % 30)) div 100 AS cost_cents",
            "(unit_cents * quantity * discount_pct) div 100 AS discount_cents",
        )
        return lines.selectExpr(
            "order_id",
            "product_id",
            "line_number",
            "created_at",
            "quantity",
            f"{_amount('unit_cents')} AS unit_price",
            f"{_amount('cost_cents')} AS cost_price",
            f"{_amount('discount_cents')} AS item_discount",
            f"{_amount('quantity * unit_cents - discount_cents')} AS total_price",
        )

    def products(self) -> DataFrame:
        named = self.categories().withColumnRenamed("category_name", "p_type")
        return self.raw("part").join(named, "p_type", "left").selectExpr(
            "p_partkey AS product_id",
            "category_id",
            "p_name AS product_name",
            "concat('PROD-', p_partkey) AS sku",
            "CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT) "
            "* (50 + p_partkey % 30) div 100 * 0.01BD AS DECIMAL(12,2)) AS cost_price",
            "CAST(p_retailprice AS DECIMAL(12,2)) AS sale_price",
            "CAST((p_partkey * 37) % 1200 AS INT) AS stock_quantity",
            "p_partkey % 17 <> 0 AS is_active",
        )

    def categories(self) -> DataFrame:
        """Product types, numbered by name; the window runs over one row per type."""
        types = self.raw("part").select("p_type").dropna().distinct()
        return types.selectExpr(
            "CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS category_id",
            "p_type AS category_name",
        )

    def customers(self, *, with_state: bool = False) -> DataFrame:
        source = self.raw("customer")
        columns = [
            "c_custkey AS customer_id",
            "split_part(c_name, '#', 1) AS first_name",
            "split_part(c_name, '#', 2) AS last_name",
            "concat(lower(replace(c_name, '#', '.')), '@example.com') AS email",
            "concat('City ', c_custkey % 50) AS city",
            "c_mktsegment AS acquisition_channel",
            "CAST(date_add(DATE '2024-01-01', CAST(c_custkey % 30 AS INT)) AS TIMESTAMP_NTZ) "
            "AS created_at",
        ]
        if not with_state:
            return source.selectExpr(*columns)
        nations = self.raw("nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS state")
        return source.join(nations, "c_nationkey").selectExpr(*columns, "state")

    def payments(self) -> DataFrame:
        return self.orders().selectExpr(
            "order_id AS payment_id",
            "order_id",
            "order_priority AS payment_method",
            f"{_PAYMENT_STATUS} AS payment_status",
            "total_amount AS amount",
            "order_date AS transaction_timestamp",
            "concat('TXN-', order_id) AS gateway_transaction_id",
        )

    def reviews(self) -> DataFrame:
        # Reviews go round all products.
        products = self.raw("part").agg(F.max("p_partkey") + 1).scalar()
        return (
            self.raw("events")
            .filter("event_type = 'purchase'")
            .select(
                F.col("event_id").alias("review_id"),
                F.col("user_id").alias("customer_id"),
                (F.col("event_id") % products).alias("product_id"),
                F.col("event_id").alias("order_id"),
                F.expr("CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS SMALLINT)").alias("rating"),
                F.col("ts").alias("created_at"),
            )
        )

    def all(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers(),
            "categories": self.categories(),
            "products": self.products(),
            "orders": self.orders(),
            "order_items": self.order_items(),
            "payments": self.payments(),
            "reviews": self.reviews(),
        }
