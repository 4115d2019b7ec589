"""Stock kept up to date from a stream of order lines.

``stock_levels`` is a streaming aggregate: Spark combines the lines of a
product inside each task before they reach its state, so a best seller costs
one partial sum per task.

``inventory_stream`` writes the line-by-line ledger. Each micro-batch runs the
batch ledger on top of the units sold by earlier batches, so it has the same
protection against a hot product. Every batch writes only below its own batch
id and replaces it on a retry, which makes the output exactly-once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwright.operators.inventory import ARRIVAL, line_columns, running_sales
from cartwright.runtime import delete

# After this many batches the units sold so far are stored as one table, so
# that a batch never has to add up more than this many small ones.
SNAPSHOT_EVERY = 20


def stock_levels(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Streaming frame of units sold and stock left per product (update mode)."""
    sold = lines.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    left = F.col("stock_quantity") - F.col("units_sold")
    return sold.join(products.select("product_id", "stock_quantity"), "product_id").select(
        "product_id", "units_sold", left.alias("stock_left"), (left < 0).alias("oversold")
    )


def _sold_between(
    spark: SparkSession, sink: str, start: int, end: int, schema: T.StructType
) -> DataFrame:
    """Units per product in the batches before ``end``.

    ``start`` is a snapshot batch (or 0): its table covers everything before it.
    """
    paths = [f"{sink}/sold/batch={b}" for b in range(start, end)]
    if start:
        paths.append(f"{sink}/sold_before/batch={start}")
    if not paths:
        return spark.createDataFrame([], schema)
    parts = spark.read.schema(schema).parquet(*paths)
    return parts.groupBy("product_id").agg(F.sum("sold").cast("bigint").alias("sold"))


def _sold_before(
    spark: SparkSession, sink: str, batch_id: int, schema: T.StructType
) -> DataFrame:
    last = (batch_id // SNAPSHOT_EVERY) * SNAPSHOT_EVERY
    if batch_id == 0 or batch_id != last:
        return _sold_between(spark, sink, last, batch_id, schema)
    path = f"{sink}/sold_before/batch={batch_id}"
    # A retry of this batch still needs the snapshot before and all that follows it.
    previous = batch_id - SNAPSHOT_EVERY
    for old in range(max(0, previous - SNAPSHOT_EVERY), previous):
        delete(spark, f"{sink}/sold/batch={old}")
        delete(spark, f"{sink}/sold_before/batch={old}")
    _sold_between(spark, sink, batch_id - SNAPSHOT_EVERY, batch_id, schema).write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.schema(schema).parquet(path)


def inventory_stream(
    lines: DataFrame,
    products: DataFrame,
    sink: str,
    checkpoint: str,
    *,
    arrival: Sequence[str] = ARRIVAL,
    unique: bool = True,
    **trigger,
) -> StreamingQuery:
    """Start the ledger. Lines are applied in batch order and, inside a batch,
    in ``arrival`` order. Results: ``<sink>/ledger/batch=<id>``, alerts are the
    rows with ``first_oversell``."""
    columns = line_columns(arrival)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*columns).persist()
        try:
            _apply(spark, rows, batch_id)
        finally:
            rows.unpersist()

    def _apply(spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        per_product = rows.groupBy("product_id").agg(
            F.sum("quantity").cast("bigint").alias("sold")
        )
        before = _sold_before(spark, sink, batch_id, per_product.schema)
        stock = (
            products.select("product_id", "stock_quantity")
            .join(per_product.select("product_id"), "product_id", "left_semi")
            .join(before, "product_id", "left")
            .select(
                "product_id",
                (F.col("stock_quantity") - F.coalesce("sold", F.lit(0))).alias("opening"),
            )
        )
        left = F.col("opening") - F.col("sold_upto")
        ledger = running_sales(rows, arrival, unique).join(stock, "product_id").select(
            *columns,
            left.alias("stock_after"),
            (left < 0).alias("oversold"),
            ((left < 0) & (left + F.col("quantity") >= 0)).alias("first_oversell"),
        )
        ledger.write.mode("overwrite").parquet(f"{sink}/ledger/batch={batch_id}")
        per_product.write.mode("overwrite").parquet(f"{sink}/sold/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
