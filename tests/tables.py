"""Small hand-made retail tables."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import SparkSession

from cartwright.sources.schemas import SCHEMAS


def day(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


def _fill(table: str, row: dict) -> tuple:
    base = {
        "customers": dict(
            first_name="Ada", last_name="Lee", email=f"c{row.get('customer_id')}@example.com",
            city="Reno", state="NV", country="United States",
            acquisition_channel="Direct", created_at=day("2023-01-01"),
        ),
        "categories": dict(category_name=f"cat {row.get('category_id')}"),
        "products": dict(
            category_id=1, product_name="thing", sku=f"S{row.get('product_id')}",
            cost_price=Decimal("4.00"), sale_price=Decimal("10.00"), stock_quantity=100,
            is_active=True, created_at=day("2023-01-01"),
        ),
        "orders": dict(
            customer_id=1, order_date=day("2024-01-10"), order_status="delivered",
            subtotal_amount=Decimal("10.00"), shipping_fee=Decimal("0.00"),
            discount_amount=Decimal("0.00"), total_amount=Decimal("10.00"),
            shipping_city="Reno", shipping_state="NV",
        ),
        "order_items": dict(
            order_id=1, product_id=1, quantity=1, unit_price=Decimal("10.00"),
            cost_price=Decimal("4.00"), item_discount=Decimal("0.00"),
        ),
        "payments": dict(
            order_id=1, payment_method="paypal", payment_status="completed",
            amount=Decimal("10.00"), transaction_timestamp=day("2024-01-10"),
            gateway_transaction_id=f"T{row.get('payment_id')}",
        ),
        "reviews": dict(
            customer_id=1, product_id=1, rating=5, is_verified_purchase=True,
            created_at=day("2024-02-01"),
        ),
    }[table]
    merged = {**base, **row}
    return tuple(merged.get(name) for name in SCHEMAS[table].names)


def frame(spark: SparkSession, table: str, *rows: dict):
    df = spark.createDataFrame([_fill(table, r) for r in rows], SCHEMAS[table])
    if table == "order_items":
        df = df.selectExpr(
            "*", "CAST(quantity * unit_price - item_discount AS DECIMAL(12,2)) AS total_price"
        )
    return df


def clean_tables(spark: SparkSession) -> dict:
    return {
        "customers": frame(spark, "customers", *[dict(customer_id=i) for i in (1, 2)]),
        "categories": frame(spark, "categories", dict(category_id=1)),
        "products": frame(spark, "products", *[dict(product_id=i) for i in (1, 2)]),
        "orders": frame(
            spark,
            "orders",
            dict(order_id=1, delivery_date=day("2024-01-12")),
            dict(order_id=2, customer_id=2, order_status="pending"),
        ),
        "order_items": frame(
            spark,
            "order_items",
            dict(order_item_id=1),
            dict(order_item_id=2, order_id=2, product_id=2),
        ),
        "payments": frame(
            spark, "payments", dict(payment_id=1), dict(payment_id=2, order_id=2)
        ),
        "reviews": frame(spark, "reviews", dict(review_id=1, order_id=1)),
    }
