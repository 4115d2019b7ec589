"""Known faults are counted; clean tables have none; ingest splits rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwright.functions import labels as L
from cartwright.operators import constraints as C
from cartwright.operators import quality
from cartwright.sources.schemas import SCHEMAS
from tables import clean_tables, day, frame

NOW = day("2025-01-01")


def _counts(df):
    return {r.check_name: r.violations for r in df.collect()}


def test_clean_tables_pass(spark):
    t = clean_tables(spark)
    card = quality.dq_scorecard(t, NOW).collect()
    assert [r.rule_id for r in card] == list(range(1, 15))
    assert {(r.violation_count, r.status) for r in card} == {(0, L.PASS)}
    for report in (quality.dq_orphans(t), quality.dq_checks(t, NOW), quality.dq_duplicates(t)):
        assert set(_counts(report).values()) == {0}


def test_seeded_faults(spark):
    t = clean_tables(spark)
    t["customers"] = frame(
        spark,
        "customers",
        dict(customer_id=1, email="x@example.com", created_at=day("2024-12-01")),
        dict(customer_id=2, email="x@example.com"),
        dict(customer_id=3, email="x@example.com"),
    )
    t["products"] = frame(
        spark,
        "products",
        dict(product_id=1, sku="A", cost_price=Decimal("11.00")),
        dict(product_id=2, sku="A"),
    )
    t["orders"] = frame(
        spark,
        "orders",
        dict(order_id=1, delivery_date=day("2024-01-01")),
        dict(order_id=2, customer_id=9, order_date=day("2026-01-01")),
        dict(order_id=3, customer_id=None, order_status="cancelled", delivery_date=NOW),
        dict(
            order_id=4, order_status="shipped", discount_amount=Decimal("11.00"),
            total_amount=Decimal("-1.00"),
        ),
        dict(order_id=5, order_status="shipped", total_amount=Decimal("10.02")),
        dict(order_id=6, order_status="shipped", total_amount=Decimal("10.01")),
    )
    t["order_items"] = frame(
        spark,
        "order_items",
        dict(order_item_id=1, order_id=1, unit_price=Decimal("9.98")),
        dict(order_item_id=2, order_id=77),
        dict(order_item_id=3, order_id=77, product_id=78, quantity=0),
    )
    t["payments"] = frame(
        spark,
        "payments",
        dict(payment_id=1, order_id=3, gateway_transaction_id="T"),
        dict(payment_id=2, order_id=99, gateway_transaction_id="T"),
    )
    t["reviews"] = frame(
        spark,
        "reviews",
        dict(review_id=1, created_at=day("2024-11-30")),
        dict(review_id=2, customer_id=50),
        dict(review_id=3, product_id=50, customer_id=2),
    )
    found = {
        **_counts(quality.dq_orphans(t)),
        **_counts(quality.dq_checks(t, NOW)),
        **_counts(quality.dq_duplicates(t)),
    }
    want = {
        "orders_customer": 2,
        "items_order": 2,
        "items_product": 1,
        "payments_order": 1,
        "reviews_parents": 2,
        "delivery_before_order": 1,
        "future_order": 1,
        "review_before_customer": 1,
        "negative_margin": 1,
        "non_positive_line": 1,
        "discount_over_subtotal": 1,
        "total_mismatch": 1,
        "lines_mismatch": 1,
        "delivered_no_date": 1,
        "undelivered_with_date": 1,
        "paid_cancelled": 1,
        "dup_email": 1,
        "dup_sku": 1,
        "dup_transaction": 1,
    }
    assert found == {L.CHECK_NAMES[k]: n for k, n in want.items()}
    card = {r.test_name: r.violation_count for r in quality.dq_scorecard(t, NOW).collect()}
    assert card == {test: want[check] for check, _, test in L.SCORECARD_RULES}


def test_orphans_use_an_anti_join(spark):
    plan = quality.dq_orphans(clean_tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftAnti") == 4


def test_enforce_collects_every_reason(spark):
    t = clean_tables(spark)
    rows = frame(
        spark,
        "orders",
        dict(order_id=1),
        dict(order_id=2, customer_id=None, order_status="lost"),
        dict(order_id=3, customer_id=8, shipping_state="N" * 51),
        dict(order_id=4, subtotal_amount=Decimal("-1.00")),
        dict(order_id=4, delivery_date=day("2024-01-09")),
    )
    valid, rejected = C.enforce(rows, C.table_rules("orders", t))
    assert [r.order_id for r in valid.collect()] == [1]
    reasons = sorted((r.order_id, sorted(r[C.REASONS])) for r in rejected.collect())
    assert reasons == [
        (2, ["customer_id is missing", "order_status is not a known value"]),
        (3, ["customer_id has no parent row", "shipping_state is longer than 50"]),
        (4, ["delivery_date is before order_date", "order_id is not unique"]),
        (4, ["order_id is not unique", "subtotal_amount is negative"]),
    ]
    assert valid.columns == SCHEMAS["orders"].names


def test_few_repeated_keys_cost_no_shuffle_of_the_rows(spark):
    key = F.when(F.col("id") < 2, 7).otherwise(F.col("id"))
    flagged = C.flag_violations(spark.range(0, 2_000_000).select(key.alias("key"), "id"), [C.Unique(("key",))])
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r.id for r in flagged.filter(F.size(C.REASONS) > 0).collect()) == [0, 1, 7]


def test_a_table_may_refer_to_itself(spark):
    rows = frame(
        spark,
        "categories",
        dict(category_id=1),
        dict(category_id=2, parent_category_id=1),
        dict(category_id=3, parent_category_id=7),
    )
    valid, _ = C.enforce(rows, C.table_rules("categories", {"categories": rows}))
    assert sorted(r.category_id for r in valid.collect()) == [1, 2]


def test_deleting_parents(spark):
    t = clean_tables(spark)
    gone = t["orders"].filter("order_id = 1")
    kept = C.cascade_delete(t["order_items"], "order_id", gone, "order_id")
    assert [r.order_item_id for r in kept.collect()] == [2]
    cleared = C.set_null_on_delete(t["reviews"], "order_id", gone, "order_id")
    assert cleared.columns == t["reviews"].columns
    assert [r.order_id for r in cleared.collect()] == [None]
    leaving = t["customers"].filter("customer_id = 1")
    with pytest.raises(C.DeletionRefused):
        C.refuse_if_referenced(t["orders"], "customer_id", leaving, "customer_id")
    stranger = frame(spark, "customers", dict(customer_id=9))
    C.refuse_if_referenced(t["orders"], "customer_id", stranger, "customer_id")
