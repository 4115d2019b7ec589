"""CSV files, the bulk load, layouts and the versioned mart."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwright.operators.constraints import REASONS
from cartwright.plans import finance, logistics, mart
from cartwright.runtime import fresh_path
from cartwright.sources import load_csv, write_csv, write_orders_by_customer, write_orders_by_status
from cartwright.sources.csv_files import CORRUPT
from cartwright.sources.loading import (
    LOAD_ORDER,
    REJECTED_FILE,
    REJECTED_LINE,
    UNREADABLE,
    load_tables,
    read_rejected,
)
from tables import clean_tables, day, frame


def _file(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_dialect_and_defaults(spark, tmp_path):
    path = _file(
        tmp_path / "products.csv",
        "product_id,category_id,product_name,sku,cost_price,sale_price,stock_quantity,is_active,created_at\n"
        '1,2,"Lamp, 12"" tall",S-1,7.50,19.99,,TRUE,2023-11-15 09:00:00+00\n'
        "2,2,Plain,S-2,1.00,2.00,5,FALSE,2023-11-15 11:00:00+02\n",
    )
    first, second = load_csv(spark, path, "products").orderBy("product_id").collect()
    assert first.product_name == 'Lamp, 12" tall'
    assert (first.cost_price, first.stock_quantity, first.is_active) == (Decimal("7.50"), 0, True)
    assert first.created_at == second.created_at


def test_generated_column(spark, tmp_path):
    path = _file(
        tmp_path / "items.csv",
        "order_item_id,order_id,product_id,quantity,unit_price,cost_price,item_discount\n"
        "1,1,1,3,9.99,4.00,1.50\n2,1,1,1,5.00,4.00,\n",
    )
    totals = [r.total_price for r in load_csv(spark, path, "order_items").collect()]
    assert totals == [Decimal("28.47"), Decimal("5.00")]


def test_unreadable_rows_fail_or_are_kept(spark, tmp_path):
    path = _file(
        tmp_path / "categories.csv",
        "category_id,category_name,parent_category_id,description\n1,A,,\nx,B,,\n",
    )
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        load_csv(spark, path, "categories").collect()
    kept = load_csv(spark, path, "categories", keep_corrupt=True).collect()
    assert [r[CORRUPT] for r in kept] == [None, "x,B,,"]


def test_csv_round_trip(spark, tmp_path):
    tables = clean_tables(spark)
    for name in ("products", "orders", "reviews"):
        path = str(tmp_path / name)
        write_csv(tables[name], path)
        key = tables[name].columns[0]
        loaded = load_csv(spark, path, name).orderBy(key).collect()
        assert loaded == tables[name].orderBy(key).collect()


def test_bulk_load(spark, tmp_path):
    tables = clean_tables(spark)
    tables["orders"] = tables["orders"].unionByName(
        frame(spark, "orders", dict(order_id=3, total_amount=Decimal("-1.00")))
    )
    for name in LOAD_ORDER:
        write_csv(tables[name].drop("total_price"), str(tmp_path / f"{name}.csv"))
    # The test customers use a known channel, so only the bad order is refused.
    out = str(tmp_path / "out")
    loaded = load_tables(spark, str(tmp_path), out, check_references=True)
    assert {n: df.count() for n, df in loaded.items()}["orders"] == 2
    (bad,) = read_rejected(spark, out, "orders", loaded["orders"].schema).collect()
    assert (bad.order_id, bad[REASONS]) == (3, ["total_amount is negative"])
    assert mart.read_mart(spark, f"{out}/mart").count() == 1
    # A second load replaces the first and publishes the mart again.
    again = load_tables(spark, str(tmp_path), out, check_references=True)
    assert again["orders"].count() == 2 and mart.current_version(spark, f"{out}/mart") == 2


def test_lines_in_quarantine(spark, tmp_path):
    """Lines of the wrong type or length are rejected rows; accepted and rejected rows are all lines."""
    for name, rows in clean_tables(spark).items():
        if name != "categories":
            write_csv(rows.drop("total_price"), str(tmp_path / f"{name}.csv"))
    lines = ["1,A,,", "x,B,,", "3", "4,D,,,,", '5,"E,,', "6,,,", "7,A,,", "8,H,,tall"]
    _file(tmp_path / "categories.csv", "category_id,category_name,parent_category_id,description\n" + "\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        load_tables(spark, str(tmp_path), out)
    loaded = load_tables(spark, str(tmp_path), out, quarantine=True)["categories"]
    assert loaded.columns == ["category_id", "category_name", "parent_category_id", "description"]
    assert [r.category_id for r in loaded.collect()] == [8]
    rejected = read_rejected(spark, out, "categories", loaded.schema).collect()
    assert len(rejected) + 1 == len(lines)
    unread = {r[REJECTED_LINE]: r for r in rejected if r[REASONS] == [UNREADABLE]}
    assert {"x,B,,", "3", "4,D,,,,"} <= set(unread)
    assert all(r[REJECTED_FILE].endswith("categories.csv") and r.category_id is None for r in unread.values())
    others = {r.category_id: r[REASONS] for r in rejected if r[REJECTED_LINE] is None}
    # An unreadable line does not make another one's key ambiguous; A stands twice in lines that can be read.
    assert others[6] == ["category_name is missing"] and others[1] == others[7] == ["category_name is not unique"]


def test_ids_beyond_32_bits(spark, tmp_path):
    big = 1 << 40
    path = _file(
        tmp_path / "items.csv",
        "order_item_id,order_id,product_id,quantity,unit_price,cost_price,item_discount\n"
        f"{big},{big + 1},{big + 2},3,9.99,4.00,1.50\n",
    )
    (row,) = load_csv(spark, path, "order_items").collect()
    assert (row.order_item_id, row.order_id, row.product_id) == (big, big + 1, big + 2)


def test_layouts_prune(spark):
    orders = frame(
        spark,
        "orders",
        *[
            dict(order_id=n, customer_id=n % 10, order_status=s)
            for n, s in enumerate(["pending", "delivered", "cancelled", "shipped"] * 10)
        ],
    )
    by_status, by_customer = fresh_path(spark, "a"), fresh_path(spark, "b")
    write_orders_by_status(orders, by_status)
    write_orders_by_customer(orders, by_customer)
    open_orders = logistics.active_orders(spark.read.parquet(by_status))
    assert open_orders.count() == 20
    plan = open_orders._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [order_status" in plan
    timeline = logistics.customer_timeline(spark.read.parquet(by_customer), 3, day("2024-01-01"))
    assert timeline.count() == 4
    plan = timeline._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_id,3)" in plan and "GreaterThanOrEqual(order_date" in plan


def _month_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_mart_versions(spark):
    root = fresh_path(spark, "mart")
    with pytest.raises(FileNotFoundError):
        mart.read_mart(spark, root)
    t = clean_tables(spark)
    assert mart.refresh_mart(spark, t["orders"], t["order_items"], root) == 1
    old = mart.read_mart(spark, root)
    more = t["orders"].unionByName(
        frame(spark, "orders", dict(order_id=3, order_date=day("2024-02-02")))
    )
    items = t["order_items"].unionByName(
        frame(spark, "order_items", dict(order_item_id=3, order_id=3))
    )
    assert mart.refresh_mart(spark, more, items, root) == 2
    # A reader of the old version is not disturbed.
    assert old.count() == 1 and mart.read_mart(spark, root).count() == 2


def test_second_of_two_publishers_is_refused(spark):
    root = fresh_path(spark, "mart")
    t = clean_tables(spark)
    rows = finance.monthly_mart(t["orders"], t["order_items"])
    assert mart.publish(spark, rows, root) == 1
    assert mart.publish(spark, rows, root, base=1) == 2
    with pytest.raises(mart.ConcurrentRefresh):
        mart.publish(spark, rows, root, base=1)
    assert mart.current_version(spark, root) == 2
    assert mart.publish(spark, rows, root) == 3


def test_repeated_month_is_not_published(spark):
    root = fresh_path(spark, "mart")
    t = clean_tables(spark)
    rows = finance.monthly_mart(t["orders"], t["order_items"])
    mart.publish(spark, rows, root)
    with pytest.raises(ValueError):
        mart.publish(spark, rows.unionByName(rows), root)
    assert mart.current_version(spark, root) == 1


def test_incremental_refresh_equals_rebuild(spark):
    root = fresh_path(spark, "mart")
    t = clean_tables(spark)
    orders = t["orders"].unionByName(
        frame(spark, "orders", dict(order_id=3, order_date=day("2024-03-03")))
    )
    items = t["order_items"].unionByName(
        frame(spark, "order_items", dict(order_item_id=3, order_id=3, quantity=2))
    )
    mart.refresh_mart(spark, orders, items, root)
    # The March order is cancelled and one of January changes its amount.
    moved = orders.withColumns(
        {
            "order_status": F.when(F.col("order_id") == 3, "cancelled").otherwise(
                F.col("order_status")
            ),
            "total_amount": F.when(F.col("order_id") == 2, Decimal("12.00")).otherwise(
                F.col("total_amount")
            ),
        }
    )
    changed = moved.filter("order_id IN (2, 3)")
    months = mart.refresh_mart_incremental(spark, moved, items, changed, root)
    assert months == [datetime.date(2024, 1, 1), datetime.date(2024, 3, 1)]
    assert _month_rows(mart.read_mart(spark, root)) == _month_rows(
        finance.monthly_mart(moved, items)
    )
    assert mart.refresh_mart_incremental(spark, moved, items, changed.limit(0), root) == []
    assert mart.current_version(spark, root) == 2
