"""Ledger, batches and streams; behaviour under skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.operators import inventory
from cartwright.plans import logistics, mart, products
from cartwright.runtime import fresh_path
from cartwright.sources.schemas import SCHEMAS
from cartwright.streaming import inventory as streamed
from cartwright.streaming import inventory_stream, monthly_stream, monthly_totals
from tables import clean_tables, day, frame


def _goods(spark):
    return frame(
        spark,
        "products",
        dict(product_id=1, stock_quantity=5),
        dict(product_id=2, stock_quantity=50),
    )


def _lines(spark, *quantities):
    return frame(
        spark,
        "order_items",
        *[
            dict(order_item_id=n, product_id=1 if n % 3 else 2, quantity=q)
            for n, q in enumerate(quantities, start=1)
        ],
    )


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ledger_flags_the_first_oversell(spark):
    ledger = inventory.inventory_ledger(
        _goods(spark), _lines(spark, 2, 3, 9, 1, 1)
    ).orderBy("order_item_id")
    got = [(r.stock_after, r.oversold, r.first_oversell) for r in ledger.collect()]
    assert got == [
        (3, False, False), (0, False, False), (41, False, False),
        (-1, True, True), (-2, True, False),
    ]


def test_copies_of_a_line(spark, monkeypatch):
    """A third of all lines are copies of one; they are written out in chunks."""
    monkeypatch.setattr(inventory, "COPIES_PER_CHUNK", 7)
    lines = spark.range(300).select(
        (F.col("id") % 3 == 0).cast("int").alias("product_id"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("at"),
        F.lit(2).alias("quantity"),
    )
    goods = frame(spark, "products", *[dict(product_id=i, stock_quantity=90) for i in (0, 1)])
    spread = inventory.inventory_ledger(goods, lines, ("at",), unique=False)
    upto = Window.partitionBy("product_id").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    left = 90 - F.sum("quantity").over(upto)
    plain = lines.withColumn("stock_after", left).select(
        *spread.columns[:-2],
        (F.col("stock_after") < 0).alias("oversold"),
        ((F.col("stock_after") < 0) & (F.col("stock_after") + 2 >= 0)).alias("first_oversell"),
    )
    assert _rows(spread) == _rows(plain)
    assert spread.filter("first_oversell").count() == 2


def test_batch_is_applied_whole_or_not_at_all(spark):
    goods = _goods(spark)
    after = inventory.apply_sales(goods, _lines(spark, 2, 3, 9))
    assert after.schema == goods.schema
    assert _rows(after.select("product_id", "stock_quantity")) == [(1, 0), (2, 41)]
    with pytest.raises(inventory.InsufficientInventory, match="product_id: 1"):
        inventory.apply_sales(goods, _lines(spark, 2, 3, 9, 1))
    impact = inventory.sale_impact(goods, _lines(spark, 2, 3, 9, 1)).collect()
    assert [(r.batch_accepted, r.stock_after) for r in impact] == [(False, 5), (False, 50)]


def _stream(spark, path, table):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("snapshot_every", [2, 20])
def test_stream_equals_batch_ledger(spark, monkeypatch, snapshot_every):
    monkeypatch.setattr(streamed, "SNAPSHOT_EVERY", snapshot_every)
    goods = _goods(spark)
    lines = _lines(spark, 1, 1, 4, 2, 1, 3, 1, 1, 2, 1, 1)
    path, sink = fresh_path(spark, "lines"), fresh_path(spark, "sink")
    for low, high in ((1, 3), (4, 6), (7, 7), (8, 9), (10, 11)):
        lines.filter(F.col("order_item_id").between(low, high)).coalesce(1).write.mode(
            "append"
        ).parquet(path)
        # A restart between slices continues from the stored state.
        inventory_stream(
            _stream(spark, path, "order_items"), goods, sink, f"{sink}-cp"
        ).awaitTermination()
    got = spark.read.parquet(f"{sink}/ledger").drop("batch")
    assert _rows(got) == _rows(inventory.inventory_ledger(goods, lines))
    # Batches before the last snapshot but one are gone.
    oldest = 2 if snapshot_every == 2 else 0
    assert min(spark.read.parquet(f"{sink}/sold").toPandas()["batch"]) == oldest


def test_monthly_stream_equals_batch(spark):
    orders = frame(
        spark,
        "orders",
        dict(order_id=1),
        dict(order_id=2, order_date=day("2024-03-01")),
        dict(order_id=3, order_status="cancelled"),
        dict(order_id=4),
    )
    path, root = fresh_path(spark, "orders"), fresh_path(spark, "root")
    # The last slice is late: it belongs to an earlier month.
    for ids in ([1], [2, 3], [4]):
        orders.filter(F.col("order_id").isin(ids)).coalesce(1).write.mode("append").parquet(path)
    monthly_stream(_stream(spark, path, "orders"), root, f"{root}-cp").awaitTermination()
    assert _rows(mart.read_mart(spark, root)) == _rows(monthly_totals(orders))


def test_hot_order_is_split_between_tasks(spark):
    """One order with a third of all lines: the line/order join splits it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    ids = spark.range(0, 60000, 1, 8)
    orders = ids.select(
        F.col("id").cast("int").alias("order_id"), F.lit("delivered").alias("order_status")
    )
    items = ids.select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("order_id"),
        (F.col("id") % 2 + 1).cast("int").alias("product_id"),
        F.lit(1).alias("quantity"),
        # Varied amounts, so that the hot order does not compress away.
        (F.xxhash64("id") % 9_000_000 / 100).cast("decimal(10,2)").alias("total_price"),
        (F.xxhash64("id", F.lit(1)) % 9_000_000 / 100).cast("decimal(10,2)").alias("cost_price"),
    )
    t = clean_tables(spark)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        sales = products.product_sales(
            t["products"], t["categories"], items, orders
        ).select("product_id", "total_units_sold", "total_revenue")
        rows = sales.collect()
        plan = sales._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted(tuple(r)[:2] for r in rows) == [(1, 30000), (2, 30000)]
    assert "SortMergeJoin(skew=true)" in plan


def test_schemas_cover_the_canonical_tables():
    assert len(SCHEMAS) == 7


def test_one_micro_batch_for_each_slice(spark):
    """However many files a slice has, the stream takes it as one batch and goes on from its checkpoint."""
    import __spark_entry__ as entry

    sink = fresh_path(spark, "sink")
    days = F.array(*[F.to_timestamp_ntz(F.lit(d)) for d in ("1996-05-01", "1998-05-01", "2000-05-01")])
    rows = spark.range(0, 120, 1, 6).select("id", F.get(days, (F.col("id") % 4).cast("int")).alias("at"))

    def start(arriving):
        query = arriving.writeStream.foreachBatch(lambda b, n: b.write.parquet(f"{sink}/batch={n}"))
        return query.option("checkpointLocation", f"{sink}-cp").trigger(availableNow=True).start()

    entry._stream_slices(rows, "at", "slices", start, late="id = 3")
    got = {(r.id, r.batch) for r in spark.read.parquet(sink).collect()}
    # Rows without a time come first, late ones last.
    assert got == {(i, 3 if i == 3 else (0, 1, 2, 0)[i % 4]) for i in range(120)}


def test_order_details_shuffles_lines_before_they_are_wide(spark):
    t = clean_tables(spark)
    details = logistics.order_details(t["orders"], t["customers"], t["order_items"], t["products"], t["categories"])
    plan = details._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "order_id" in joins[0] and "product_id" in joins[1]
