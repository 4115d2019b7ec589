"""Faults planted in the retail tables, so that the quality checks have something to find.

For each table the columns that are changed and what they become; both engines
read these expressions.
"""


def _where(fault: str, value: str, column: str) -> str:
    return f"CASE WHEN {fault} THEN {value} ELSE {column} END"


FAULTS: dict[str, dict[str, str]] = {
    "orders": {
        "customer_id": _where("order_id % 107 = 3", "-1", "customer_id"),
        "order_date": _where("order_id % 109 = 3", "order_date + INTERVAL '40' YEAR", "order_date"),
        "delivery_date": "CASE WHEN order_id % 113 = 3 THEN NULL"
        " WHEN order_id % 127 = 3 THEN order_date - INTERVAL '1' DAY"
        " WHEN order_id % 131 = 3 THEN order_date + INTERVAL '1' DAY ELSE delivery_date END",
        "total_amount": _where("order_id % 137 = 3", "total_amount + 1", "total_amount"),
        "discount_amount": _where("order_id % 139 = 3", "subtotal_amount + 1", "discount_amount"),
    },
    "order_items": {
        "order_id": _where("order_id % 149 = 3", "-1", "order_id"),
        "product_id": _where("product_id % 151 = 3", "-1", "product_id"),
        "quantity": _where("order_id % 157 = 3", "0", "quantity"),
    },
    "products": {
        "cost_price": _where("product_id % 11 = 3", "sale_price + 1", "cost_price"),
        "sku": _where("product_id % 13 = 3", "'PROD-twice'", "sku"),
    },
    "customers": {
        "email": _where("customer_id % 17 = 3", "'twice@example.com'", "email"),
        "created_at": _where("customer_id % 19 = 3", "created_at + INTERVAL '40' YEAR", "created_at"),
    },
    "payments": {
        "order_id": _where("order_id % 163 = 3", "-1", "order_id"),
        "payment_status": _where("order_id % 140 = 0", "'completed'", "payment_status"),
        "gateway_transaction_id": _where("order_id % 167 = 3", "'TXN-twice'", "gateway_transaction_id"),
    },
    "reviews": {"customer_id": _where("review_id % 173 = 3", "-1", "customer_id")},
}
