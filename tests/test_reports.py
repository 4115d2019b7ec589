"""Edges of the reports on hand-made tables."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwright.functions import money, percent
from cartwright.functions import labels as L
from cartwright.plans import cohorts, customers, finance, logistics, payments, products
from cartwright.plans import reports as R
from tables import clean_tables, day, frame


def test_fan_out_counts_an_order_once_per_line(spark):
    orders = frame(
        spark,
        "orders",
        dict(order_id=1, total_amount=Decimal("30.00")),
        dict(order_id=2, order_date=day("2024-03-01"), total_amount=Decimal("15.00")),
        dict(order_id=3, order_status="cancelled", total_amount=Decimal("99.00")),
        dict(order_id=4, total_amount=Decimal("50.00")),
    )
    items = frame(
        spark,
        "order_items",
        dict(order_item_id=1, order_id=1),
        dict(order_item_id=2, order_id=1, quantity=2),
        dict(order_item_id=3, order_id=2),
        dict(order_item_id=4, order_id=3),
    )
    march, january = finance.monthly_kpis(orders, items).collect()
    assert (january.net_revenue, january.total_orders) == (Decimal("60.00"), 1)
    assert january.total_cogs == Decimal("12.00")
    assert january.mom_net_revenue_growth_pct is None
    # February has no orders: growth is taken over January.
    assert march.mom_net_revenue_growth_pct == -75.0
    once = finance.monthly_kpis_order_grain(orders, items).collect()
    assert once[1].net_revenue == Decimal("30.00")
    printed = R.print_monthly_kpis(finance.monthly_kpis(orders, items)).collect()
    assert (printed[0].mom_growth, printed[1].mom_growth) == ("-75.00%", L.BASE_MONTH)
    assert printed[1].net_revenue == "$60.00"


def test_channels_keep_customers_without_orders(spark):
    people = frame(
        spark,
        "customers",
        dict(customer_id=1),
        dict(customer_id=2),
        dict(customer_id=3, acquisition_channel="Referral"),
    )
    orders = frame(
        spark,
        "orders",
        dict(order_id=1, customer_id=1),
        dict(order_id=2, customer_id=1),
        dict(order_id=3, customer_id=3, order_status="cancelled"),
    )
    direct, referral = finance.channel_performance(people, orders).collect()
    assert tuple(direct)[1:] == (2, 2, Decimal("20.00"), 10.0, 66.67)
    assert tuple(referral)[1:] == (1, 0, Decimal("0.00"), 0.0, 33.33)


@pytest.mark.parametrize(
    "scores, name",
    [
        ((4, 4, 4), L.CHAMPIONS),
        ((3, 5, 3), L.LOYAL),
        ((5, 2, 5), L.RECENT),
        ((3, 1, 4), L.BIG_SPENDERS),
        ((2, 3, 1), L.NEED_ATTENTION),
        ((1, 3, 3), L.AT_RISK),
        ((2, 2, 3), L.HIBERNATING),
        ((1, 1, 2), L.LOST),
        ((3, 2, 3), L.STANDARD),
    ],
)
def test_every_segment_rule(spark, scores, name):
    row = spark.createDataFrame([scores], "r int, f int, m int")
    assert row.select(F.expr(L.segment_case())).first()[0] == name


def test_recency_counts_from_cancelled_orders_too(spark):
    people = frame(spark, "customers", dict(customer_id=1), dict(customer_id=2))
    orders = frame(
        spark,
        "orders",
        dict(order_id=1, order_date=day("2024-01-01T12:00:00")),
        dict(
            order_id=2, customer_id=2, order_status="cancelled",
            order_date=day("2024-01-11T11:00:00"),
        ),
    )
    (row,) = customers.rfm_scores(people, orders).collect()
    assert (row.customer_id, row.recency_days, row.r_score) == (1, 9, 1)


def test_cells_rank_customers_without_orders_last(spark):
    people = frame(spark, "customers", *[dict(customer_id=i) for i in range(1, 6)])
    orders = frame(
        spark,
        "orders",
        *[
            dict(order_id=i, customer_id=i, order_date=day(f"2024-01-0{i}"))
            for i in range(1, 5)
        ],
    )
    cells = customers.rfm_score_cells(people, orders, datetime.date(2024, 1, 2)).collect()
    assert cells[0].r_score == 5 and cells[0].avg_segment_spend == 0.0
    assert sum(c.total_customers for c in cells) == 5


def test_cohorts(spark):
    orders = frame(
        spark,
        "orders",
        dict(order_id=1, customer_id=1, order_date=day("2024-01-05")),
        dict(order_id=2, customer_id=1, order_date=day("2024-01-25")),
        dict(order_id=3, customer_id=1, order_date=day("2024-03-05")),
        dict(order_id=4, customer_id=2, order_date=day("2024-01-06")),
        dict(order_id=5, customer_id=3, order_date=day("2024-03-31")),
    )
    long = cohorts.cohort_retention_long(orders)
    rows = sorted((str(r[0]), *r[1:]) for r in long.collect())
    assert rows == [("2024-01-01", 2, 0, 2), ("2024-01-01", 2, 2, 1), ("2024-03-01", 1, 0, 1)]
    first = R.print_cohort_matrix(cohorts.cohort_retention_matrix(long)).first()
    assert (first.m1_retention, first.m2_retention) == ("0.0%", "50.0%")
    observed = {r[0]: r[2] for r in cohorts.retention_curve(long).collect()}
    padded = {r[0]: r[2] for r in cohorts.retention_curve(long, censor=False).collect()}
    assert observed == {0: 100.0, 1: 0.0, 2: 50.0}
    assert padded == {0: 100.0, 1: 0.0, 2: 25.0}


def test_pareto_edges_and_ties(spark):
    prices = ["80.00", "5.00", "5.00", "5.00", "5.00"]
    items = frame(
        spark,
        "order_items",
        *[
            dict(order_item_id=i, product_id=i, unit_price=Decimal(p))
            for i, p in enumerate(prices, start=1)
        ],
    )
    t = clean_tables(spark)
    goods = frame(spark, "products", *[dict(product_id=i) for i in range(1, 6)])
    rows = products.product_pareto(goods, t["categories"], items, t["orders"]).collect()
    assert [r.revenue_rank for r in rows] == [1, 2, 2, 2, 2]
    assert rows[0].pareto_classification == L.TIER_A[1]
    # Equal revenues share the running total.
    assert {r.cumulative_revenue_pct for r in rows[1:]} == {100.0}
    assert rows[4].pareto_classification == L.TIER_C


def test_return_rate_flags(spark):
    t = clean_tables(spark)
    orders = frame(
        spark,
        "orders",
        *[
            dict(order_id=i, order_status="returned" if i == 1 else "cancelled")
            for i in range(1, 16)
        ],
    )
    lines = [
        dict(order_item_id=2 * i + k, order_id=i, product_id=1) for i in range(1, 16) for k in (0, 1)
    ]
    items = frame(spark, "order_items", *lines)
    for rating, flag in [((5, 4, 4, 4, 4), L.RATED_HIGH[1]), ((4, 3), L.RATED_FAIR[1]), ((), L.RATED_LOW)]:
        reviews = frame(
            spark, "reviews", *[dict(review_id=n, rating=r) for n, r in enumerate(rating)]
        )
        (row,) = products.product_return_vs_rating(
            t["products"], t["categories"], items, orders, reviews
        ).collect()
        assert (row.total_orders_containing_product, row.returned_orders_count) == (15, 1)
        assert row.satisfaction_flag == flag


def test_states_need_twenty_deliveries(spark):
    rows = [
        dict(
            order_id=n, shipping_state="NV" if n < 20 else "UT",
            delivery_date=day("2024-01-14") if n % 2 else day("2024-01-16"),
        )
        for n in range(39)
    ]
    orders = frame(spark, "orders", *rows)
    (row,) = logistics.delivery_sla_by_state(orders).collect()
    assert (row.shipping_state, row.total_deliveries) == ("NV", 20)
    assert (row.median_delivery_days, row.on_time_sla_pct) == (5.0, 50.0)


def test_pending_payments_count_in_total_only(spark):
    rows = frame(
        spark,
        "payments",
        dict(payment_id=1),
        dict(payment_id=2, payment_status="pending"),
        dict(payment_id=3, payment_status="refunded"),
    )
    (row,) = payments.payment_method_health(rows).collect()
    assert (row.total_transactions, row.successful_payments, row.failed_payments) == (3, 1, 0)
    assert row.total_processed_volume == Decimal("30.00")
    assert row.total_refund_leakage == Decimal("10.00")


def test_text_formats(spark):
    row = spark.range(1).select(
        money(F.lit(Decimal("1234567.125"))), money(F.lit(-12.5)), percent(F.lit(1234.5))
    ).first()
    assert tuple(row) == ("$1,234,567.13", "$-12.50", "1234.50%")


def test_zero_revenue_has_no_margin(spark):
    orders = frame(spark, "orders", dict(order_id=1, total_amount=Decimal("0.00")))
    items = frame(spark, "order_items", dict(order_item_id=1))
    (row,) = finance.monthly_kpis(orders, items).collect()
    assert row.gross_margin_pct is None
    assert R.print_monthly_kpis(finance.monthly_kpis(orders, items)).first().gross_margin == "%"


def test_search_takes_wildcards_literally(spark):
    goods = frame(
        spark,
        "products",
        dict(product_id=1, product_name="100% Cotton_Tee"),
        dict(product_id=2, product_name="1000 Cotton Tee"),
    )
    assert [r[0] for r in products.catalog_search(goods, "100%").collect()] == [1]
    assert [r[0] for r in products.catalog_search(goods, "n_t").collect()] == [1]


def test_pareto_top_counts_ties_that_it_leaves_out(spark):
    """Five products tie on the second place; two of them are shown, all five are summed."""
    one = datetime.datetime(2024, 1, 1)
    revenue = {1: "50.00", **{p: "10.00" for p in range(2, 7)}, 7: "1.00"}
    categories = spark.createDataFrame([(1, "c")], "category_id int, category_name string")
    products_ = spark.createDataFrame(
        [(p, 1, f"p{p}", f"s{p}", 5) for p in revenue],
        "product_id int, category_id int, product_name string, sku string, stock_quantity int",
    )
    orders = spark.createDataFrame(
        [(1, "delivered", one)], "order_id int, order_status string, order_date timestamp"
    )
    items = spark.createDataFrame(
        [(1, p, 1, Decimal(r), Decimal("0.50")) for p, r in revenue.items()],
        "order_id int, product_id int, quantity int, total_price decimal(12,2), cost_price decimal(10,2)",
    )
    shown = products.pareto_top(products_, categories, items, orders, n=3).collect()
    assert [(r.product_id, r.cumulative_revenue) for r in shown] == [
        (1, Decimal("50.00")), (2, Decimal("100.00")), (3, Decimal("100.00")),
    ]
