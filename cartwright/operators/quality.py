"""Data-quality checks and the scorecard.

Every check counts violations. Foreign keys are counted per key value before
they are looked up, so a key with very many rows (a third of the orders on one
customer, say) reaches the join as one row. Checks on one table's own columns
share a single pass over it.
"""

from __future__ import annotations

import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.functions import CANCELLED, amount, cents, moment
from cartwright.functions import labels as L

Tables = dict[str, DataFrame]


def _cent() -> Column:
    return F.lit(Decimal("0.01"))


def _moment(as_of: datetime.datetime | None, like: DataFrame, column: str) -> Column:
    """The instant that counts as now; the clock unless the caller fixes it."""
    if as_of is None:
        return F.current_timestamp()
    return moment(as_of, like.schema[column].dataType)


def _as_rows(one_row: DataFrame) -> DataFrame:
    """Turn one row of named counts into (check, violations) rows."""
    entries = [
        F.struct(F.lit(c).alias("check"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("violations"))
        for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*entries)))


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_as_rows(p) for p in parts])


# ------------------------------------------------------- building blocks


def _orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key counts."""
    per_key = child.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__rows"))
    known = parent.select(F.col(parent_key).alias("__key"))
    return per_key.join(known, "__key", "left_anti").agg(F.sum("__rows").alias(name))


def _orphan_reviews(t: Tables) -> DataFrame:
    pairs = t["reviews"].groupBy("customer_id", "product_id").agg(F.count("*").alias("__rows"))
    customers = t["customers"].select("customer_id", F.lit(True).alias("__customer"))
    products = t["products"].select("product_id", F.lit(True).alias("__product"))
    return (
        pairs.join(customers, "customer_id", "left")
        .join(products, "product_id", "left")
        .filter(F.col("__customer").isNull() | F.col("__product").isNull())
        .agg(F.sum("__rows").alias("reviews_parents"))
    )


def _order_rules(orders: DataFrame, as_of: datetime.datetime | None) -> dict[str, Column]:
    status, delivered_at = F.col("order_status"), F.col("delivery_date")
    expected = F.col("subtotal_amount") - F.col("discount_amount") + F.col("shipping_fee")
    return {
        "delivery_before_order": delivered_at < F.col("order_date"),
        "future_order": F.col("order_date") > _moment(as_of, orders, "order_date"),
        "discount_over_subtotal": F.col("discount_amount") > F.col("subtotal_amount"),
        "total_mismatch": F.abs(expected - F.col("total_amount")) > _cent(),
        "delivered_no_date": (status == "delivered") & delivered_at.isNull(),
        "undelivered_with_date": status.isin(L.NO_DELIVERY_STATUSES) & delivered_at.isNotNull(),
    }


def _counts(df: DataFrame, rules: dict[str, Column], wanted: list[str] | None = None) -> DataFrame:
    names = list(rules) if wanted is None else wanted
    return df.agg(*[F.count_if(rules[n]).alias(n) for n in names])


def _negative_margin(t: Tables) -> DataFrame:
    return _counts(t["products"], {"negative_margin": F.col("sale_price") < F.col("cost_price")})


def _lines_against_orders(t: Tables) -> DataFrame:
    """Orphan lines and header/line mismatches from one aggregate of the lines."""
    per_order = t["order_items"].groupBy("order_id").agg(
        F.count("*").alias("__rows"),
        amount(F.sum(cents(t["order_items"], "total_price"))).alias("__lines"),
    )
    headers = t["orders"].select("order_id", "subtotal_amount", F.lit(True).alias("__found"))
    found = F.col("__found").isNotNull()
    gap = F.abs(F.col("subtotal_amount") - F.coalesce("__lines", F.lit(0)))
    return per_order.join(headers, "order_id", "left").agg(
        F.sum(F.when(~found, F.col("__rows"))).alias("items_order"),
        F.count_if(found & (gap > _cent())).alias("lines_mismatch"),
    )


def _payments_against_orders(t: Tables) -> DataFrame:
    """Orphan payments and settled payments of cancelled orders from one join."""
    per_order = t["payments"].groupBy("order_id").agg(
        F.count("*").alias("__rows"),
        F.count_if(F.col("payment_status") == "completed").alias("__settled"),
    )
    headers = t["orders"].select("order_id", "order_status", F.lit(True).alias("__found"))
    return per_order.join(headers, "order_id", "left").agg(
        F.sum(F.when(F.col("__found").isNull(), F.col("__rows"))).alias("payments_order"),
        F.sum(F.when(F.col("order_status") == CANCELLED, F.col("__settled"))).alias(
            "paid_cancelled"
        ),
    )


def _duplicated_values(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number of values (not rows) that occur more than once."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("__rows"))
        .agg(F.count_if(F.col("__rows") > 1).alias(name))
    )


def _early_reviews(t: Tables) -> DataFrame:
    registered = t["customers"].select("customer_id", F.col("created_at").alias("__since"))
    return (
        t["reviews"]
        .select("customer_id", "created_at")
        .join(registered, "customer_id")
        .agg(F.count_if(F.col("created_at") < F.col("__since")).alias("review_before_customer"))
    )


def _named(checks: DataFrame) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in L.CHECK_NAMES.items() for x in pair])
    return checks.select(names[F.col("check")].alias("check_name"), "violations")


# ------------------------------------------------------------------ reports


def dq_orphans(t: Tables) -> DataFrame:
    """The five referential checks."""
    return _named(
        _stack(
            [
                _orphans(t["orders"], "customer_id", t["customers"], "customer_id", "orders_customer"),
                _orphans(t["order_items"], "order_id", t["orders"], "order_id", "items_order"),
                _orphans(t["order_items"], "product_id", t["products"], "product_id", "items_product"),
                _orphans(t["payments"], "order_id", t["orders"], "order_id", "payments_order"),
                _orphan_reviews(t),
            ]
        )
    )


def dq_checks(t: Tables, as_of: datetime.datetime | None = None) -> DataFrame:
    """The eleven temporal, financial and status checks."""
    line = t["order_items"]
    bad_line = (
        (F.col("quantity") <= 0) | (F.col("unit_price") <= 0) | (F.col("cost_price") < 0)
    )
    return _named(
        _stack(
            [
                _counts(t["orders"], _order_rules(t["orders"], as_of)),
                _early_reviews(t),
                _negative_margin(t),
                _counts(line, {"non_positive_line": bad_line}),
                _lines_against_orders(t).select("lines_mismatch"),
                _payments_against_orders(t).select("paid_cancelled"),
            ]
        )
    )


def dq_duplicates(t: Tables) -> DataFrame:
    """The three uniqueness checks."""
    return _named(
        _stack(
            [
                _duplicated_values(t["customers"], "email", "dup_email"),
                _duplicated_values(t["products"], "sku", "dup_sku"),
                _duplicated_values(t["payments"], "gateway_transaction_id", "dup_transaction"),
            ]
        )
    )


def dq_scorecard(t: Tables, as_of: datetime.datetime | None = None) -> DataFrame:
    """The fourteen scorecard rules with PASS or FAIL, in rule order.

    Four rules share the pass over orders, and the two rules on lines against
    orders and the two on payments against orders share one join each.
    """
    in_orders = ["delivery_before_order", "future_order", "total_mismatch", "delivered_no_date"]
    counts = _stack(
        [
            _counts(t["orders"], _order_rules(t["orders"], as_of), in_orders),
            _negative_margin(t),
            _lines_against_orders(t),
            _payments_against_orders(t),
            _orphans(t["orders"], "customer_id", t["customers"], "customer_id", "orders_customer"),
            _orphans(t["order_items"], "product_id", t["products"], "product_id", "items_product"),
            _duplicated_values(t["customers"], "email", "dup_email"),
            _duplicated_values(t["products"], "sku", "dup_sku"),
            _duplicated_values(t["payments"], "gateway_transaction_id", "dup_transaction"),
        ]
    )
    rules = F.create_map(
        *[
            part
            for number, (check, category, test) in enumerate(L.SCORECARD_RULES, start=1)
            for part in (
                F.lit(check),
                F.struct(
                    F.lit(number).alias("rule_id"),
                    F.lit(category).alias("category"),
                    F.lit(test).alias("test_name"),
                ),
            )
        ]
    )
    return (
        counts.withColumn("rule", rules[F.col("check")])
        .select(
            "rule.rule_id",
            "rule.category",
            "rule.test_name",
            F.col("violations").alias("violation_count"),
            F.when(F.col("violations") == 0, L.PASS).otherwise(L.FAIL).alias("status"),
        )
        .orderBy("rule_id")
    )
