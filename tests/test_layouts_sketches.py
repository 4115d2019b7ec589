"""Bucketed tables and percentile sketches."""

import random

import pytest
from pyspark.sql import functions as F

from cartwright.operators import sketches
from cartwright.plans import finance, logistics
from cartwright.runtime import fresh_path
from cartwright.sources import UnevenBuckets, write_bucketed
from cartwright.sources.published import PublishedTable
from tables import clean_tables, day, frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_and_lines_meet_without_a_shuffle(spark):
    t = clean_tables(spark)
    orders, items = (
        write_bucketed(t[name], "order_id", 4, fresh_path(spark, name)) for name in ("orders", "order_items")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = orders.join(items.groupBy("order_id").agg(F.sum("quantity").alias("units")), "order_id")
        assert "Exchange" not in _plan(joined)
        plain = t["orders"].join(
            t["order_items"].groupBy("order_id").agg(F.sum("quantity").alias("units")), "order_id"
        )
        assert "Exchange" in _plan(plain)
        assert sorted(map(str, joined.collect())) == sorted(map(str, plain.select(joined.columns).collect()))
        same = finance.monthly_kpis(orders, items).collect()
        assert same == finance.monthly_kpis(t["orders"], t["order_items"]).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_customer_reads_one_bucket(spark):
    orders = frame(spark, "orders", *[dict(order_id=n, customer_id=n % 10) for n in range(40)])
    path = fresh_path(spark, "by-customer")
    stored = write_bucketed(orders, "customer_id", 8, path, order=["order_date", "order_id"])
    # The plan names the buckets of bucketed scans only; pruning is the same in others.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        found = logistics.customer_timeline(stored, 3, day("2024-01-01"))
        assert found.count() == 4
        assert "SelectedBucketsCount: 1 out of 8" in _plan(found)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_a_hot_key_is_refused(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    with pytest.raises(UnevenBuckets):
        write_bucketed(rows, "k", 64, fresh_path(spark, "hot"))


def test_empty_table_in_buckets(spark):
    stored = write_bucketed(spark.range(0), "id", 4, fresh_path(spark, "none"))
    assert stored.count() == 0 and stored.columns == ["id"]


WANTED = {"low": 0.1, "middle": 0.5, "high": 0.9}


def _values(spark):
    """A third of the rows in one group, ties, NULL values, a group without a value, a NULL group."""
    rng = random.Random(5)
    rows = [
        ("hot" if n % 3 == 0 else rng.choice(["a", "b", None]), rng.choice([None, 4.0, rng.expovariate(1)]), n % 7)
        for n in range(60_000)
    ]
    return spark.createDataFrame([*rows, ("empty", None, 0)], "g string, v double, part int")


def test_merged_sketches_keep_their_error(spark):
    df = _values(spark)
    merged = sketches.merge_sketches(sketches.sketch_values(df, ["g", "part"], "v"), ["g"])
    read = sketches.read_percentiles(merged, WANTED)
    misses = {r["g"]: r for r in sketches.rank_misses(df, "g", "v", read, WANTED).collect()}
    assert set(misses) == {"hot", "a", "b", None}
    counts = df.filter("v IS NOT NULL").groupBy("g").count().collect()
    assert {g: r["rows"] for g, r in misses.items()} == {r["g"]: r["count"] for r in counts}
    assert all(r[name] <= sketches.rank_error() for r in misses.values() for name in WANTED)


def test_misses_are_seen(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    wrong = spark.createDataFrame([("g", 99.0, 700.0, 899.0)], "g string, low double, middle double, high double")
    (row,) = sketches.rank_misses(df, "g", "v", wrong, WANTED).collect()
    assert (row.rows, row.low, round(row.middle, 9), row.high) == (1000, 0.0, 0.2, 0.0)


def test_small_groups_are_exact(spark):
    df = spark.range(101).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    (row,) = sketches.read_percentiles(sketches.sketch_values(df, ["g"], "v"), {"p": 0.5}).collect()
    assert row.p == 50.0


def _shipped(spark, rows):
    return frame(
        spark,
        "orders",
        *[
            dict(order_id=n, order_status="delivered", order_date=day(at), delivery_date=day(to), shipping_state=state)
            for n, (at, to, state) in enumerate(rows)
        ],
    )


def test_late_deliveries_touch_their_month_alone(spark):
    root = fresh_path(spark, "sketches")
    first = _shipped(
        spark,
        [("2024-01-01", "2024-01-03", "X"), ("2024-01-05", "2024-01-09", "X"), ("2024-02-01", "2024-02-02", "X")],
    )
    late = _shipped(spark, [("2024-01-10", "2024-01-20", "X"), ("2024-01-11", "2024-01-12", "Y")])
    assert logistics.add_deliveries(spark, first, root) == 1
    table = PublishedTable(spark, root, "order_month")
    before = table.manifest().parts
    assert logistics.add_deliveries(spark, late, root) == 2
    after = table.manifest().parts
    assert [k for k in after if after[k] == before.get(k)] == ["2024-02-01"]

    def read(**months):
        rows = logistics.delivery_percentiles(spark, root, **months).collect()
        return {r["shipping_state"]: (r["sketched_rows"], r["median_delivery_days"]) for r in rows}

    assert read()["X"][0] == 4 and read()["Y"] == (1, 1.0)
    assert read(until=day("2024-01-01").date())["X"] == (3, 4.0)
    assert read(since=day("2024-02-01").date()) == {"X": (1, 1.0)}


def test_nothing_delivered_changes_nothing(spark):
    root = fresh_path(spark, "sketches")
    logistics.add_deliveries(spark, _shipped(spark, [("2024-01-01", "2024-01-03", "X")]), root)
    logistics.add_deliveries(spark, _shipped(spark, [("2024-01-01", "2024-01-03", "X")]).limit(0), root)
    assert logistics.delivery_percentiles(spark, root).count() == 1
