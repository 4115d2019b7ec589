"""Explicit schemas, column defaults and limits of the seven retail tables.

Nothing is inferred from data. Spark does not enforce keys or checks on write;
``operators.constraints`` turns the limits below into an ingest job.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# fixed values: columns of the seven tables and their types; ids have 64 bits
SCHEMAS: dict[str, T.StructType] = {
    "customers": _table(
        ("customer_id", T.LongType()),
        ("first_name", T.StringType()),
        ("last_name", T.StringType()),
        ("email", T.StringType()),
        ("phone", T.StringType()),
        ("city", T.StringType()),
        ("state", T.StringType()),
        ("postal_code", T.StringType()),
        ("country", T.StringType()),
        ("acquisition_channel", T.StringType()),
        ("created_at", T.TimestampType()),
    ),
    "categories": _table(
        ("category_id", T.LongType()),
        ("category_name", T.StringType()),
        ("parent_category_id", T.LongType()),
        ("description", T.StringType()),
    ),
    "products": _table(
        ("product_id", T.LongType()),
        ("category_id", T.LongType()),
        ("product_name", T.StringType()),
        ("sku", T.StringType()),
        ("cost_price", MONEY),
        ("sale_price", MONEY),
        ("stock_quantity", T.IntegerType()),
        ("is_active", T.BooleanType()),
        ("created_at", T.TimestampType()),
    ),
    "orders": _table(
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("order_date", T.TimestampType()),
        ("order_status", T.StringType()),
        ("subtotal_amount", MONEY),
        ("shipping_fee", MONEY),
        ("discount_amount", MONEY),
        ("total_amount", MONEY),
        ("shipping_city", T.StringType()),
        ("shipping_state", T.StringType()),
        ("shipping_postal_code", T.StringType()),
        ("delivery_date", T.TimestampType()),
    ),
    "order_items": _table(
        ("order_item_id", T.LongType()),
        ("order_id", T.LongType()),
        ("product_id", T.LongType()),
        ("quantity", T.IntegerType()),
        ("unit_price", MONEY),
        ("cost_price", MONEY),
        ("item_discount", MONEY),
    ),
    "payments": _table(
        ("payment_id", T.LongType()),
        ("order_id", T.LongType()),
        ("payment_method", T.StringType()),
        ("payment_status", T.StringType()),
        ("amount", MONEY),
        ("transaction_timestamp", T.TimestampType()),
        ("gateway_transaction_id", T.StringType()),
    ),
    "reviews": _table(
        ("review_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("product_id", T.LongType()),
        ("order_id", T.LongType()),
        ("rating", T.ShortType()),
        ("review_title", T.StringType()),
        ("review_text", T.StringType()),
        ("is_verified_purchase", T.BooleanType()),
        ("created_at", T.TimestampType()),
    ),
}

# fixed values: column defaults. NOW means the load's own timestamp.
NOW = object()
DEFAULTS: dict[str, dict[str, object]] = {
    "customers": {"country": "United States", "created_at": NOW},
    "categories": {},
    "products": {"stock_quantity": 0, "is_active": True, "created_at": NOW},
    "orders": {
        "order_date": NOW,
        "order_status": "pending",
        "subtotal_amount": Decimal("0.00"),
        "shipping_fee": Decimal("0.00"),
        "discount_amount": Decimal("0.00"),
        "total_amount": Decimal("0.00"),
    },
    "order_items": {"item_discount": Decimal("0.00")},
    "payments": {"payment_status": "pending", "transaction_timestamp": NOW},
    "reviews": {"is_verified_purchase": False, "created_at": NOW},
}

# fixed values: columns that must hold a value
REQUIRED: dict[str, list[str]] = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "city", "state",
        "country", "acquisition_channel", "created_at",
    ],
    "categories": ["category_id", "category_name"],
    "products": [
        "product_id", "category_id", "product_name", "sku", "cost_price",
        "sale_price", "stock_quantity", "is_active", "created_at",
    ],
    "orders": [
        "order_id", "customer_id", "order_date", "order_status", "subtotal_amount",
        "shipping_fee", "discount_amount", "total_amount", "shipping_city", "shipping_state",
    ],
    "order_items": [
        "order_item_id", "order_id", "product_id", "quantity", "unit_price",
        "cost_price", "item_discount",
    ],
    "payments": [
        "payment_id", "order_id", "payment_method", "payment_status", "amount",
        "transaction_timestamp", "gateway_transaction_id",
    ],
    "reviews": [
        "review_id", "customer_id", "product_id", "rating", "is_verified_purchase", "created_at",
    ],
}

# fixed values: keys without duplicates
UNIQUE_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id", "email"],
    "categories": ["category_id", "category_name"],
    "products": ["product_id", "sku"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "payments": ["payment_id", "gateway_transaction_id"],
    "reviews": ["review_id"],
}

# fixed values: (child column, parent table, parent key, what a parent's deletion does)
FOREIGN_KEYS: dict[str, list[tuple[str, str, str, str]]] = {
    "customers": [],
    "categories": [("parent_category_id", "categories", "category_id", "set_null")],
    "products": [("category_id", "categories", "category_id", "restrict")],
    "orders": [("customer_id", "customers", "customer_id", "restrict")],
    "order_items": [
        ("order_id", "orders", "order_id", "cascade"),
        ("product_id", "products", "product_id", "restrict"),
    ],
    "payments": [("order_id", "orders", "order_id", "cascade")],
    "reviews": [
        ("customer_id", "customers", "customer_id", "cascade"),
        ("product_id", "products", "product_id", "cascade"),
        ("order_id", "orders", "order_id", "set_null"),
    ],
}

# fixed values: longest text per column
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "customers": {
        "first_name": 50, "last_name": 50, "email": 100, "phone": 25, "city": 60,
        "state": 50, "postal_code": 20, "country": 50, "acquisition_channel": 40,
    },
    "categories": {"category_name": 80},
    "products": {"product_name": 150, "sku": 40},
    "orders": {"shipping_city": 60, "shipping_state": 50, "shipping_postal_code": 20},
    "order_items": {},
    "payments": {"gateway_transaction_id": 80},
    "reviews": {"review_title": 120},
}
