"""Stock after sales: a running ledger, and all-or-nothing batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.ranking import grouped_running_sum
from cartwright.runtime import materialize

# Columns in whose order lines reach the stock: line ids grow as lines are
# inserted. Another choice must order a product's lines up to identical rows.
ARRIVAL = ("order_item_id",)

# Copies of one line that a task writes out from one row.
COPIES_PER_CHUNK = 100_000


class InsufficientInventory(RuntimeError):
    """A batch would take some product below zero; nothing was applied."""


def line_columns(arrival: Sequence[str]) -> list[str]:
    """Columns of a line that the ledger reads."""
    return list(dict.fromkeys(["product_id", "quantity", *arrival]))


def running_sales(
    items: DataFrame, arrival: Sequence[str] = ARRIVAL, unique: bool = True
) -> DataFrame:
    """Lines with ``sold_upto``: units of the product sold up to and with the line.

    The running sum is taken over range partitions of (product, arrival), so a
    best seller spreads over many tasks.

    ``unique`` says that no two lines of a product share their arrival values.
    Otherwise equal rows are interchangeable, and any number of copies of a
    line is summed as one row and written out again afterwards.
    """
    if unique:
        return grouped_running_sum(items, "product_id", arrival, "quantity", "sold_upto")
    copies = (
        items.groupBy(*items.columns)
        .agg(F.count("*").alias("__copies"))
        .withColumn("__units", F.col("__copies") * F.col("quantity"))
    )
    summed = grouped_running_sum(copies, "product_id", arrival, "__units", "sold_upto")
    return _write_out_copies(summed, items.columns)


def _write_out_copies(summed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy again.

    A line of up to one chunk of copies is written out where it lies; only
    lines with more are sent chunk by chunk to other tasks.
    """
    last_chunk = F.expr(f"(__copies - 1) div {COPIES_PER_CHUNK}")
    few = summed.filter(F.col("__copies") <= COPIES_PER_CHUNK).withColumn("__chunk", F.lit(0))
    many = (
        summed.filter(F.col("__copies") > COPIES_PER_CHUNK)
        .withColumn("__chunk", F.explode(F.sequence(F.lit(0), last_chunk)))
        .repartition(*columns, "__chunk")
    )
    before = F.col("sold_upto") - F.col("__units")

    def written(chunks: DataFrame) -> DataFrame:
        first = F.col("__chunk") * COPIES_PER_CHUNK + 1
        last = F.least((F.col("__chunk") + 1) * COPIES_PER_CHUNK, F.col("__copies"))
        nth = chunks.withColumn("__nth", F.explode(F.sequence(first, last)))
        return nth.select(
            *columns, (before + F.col("__nth") * F.col("quantity")).alias("sold_upto")
        )

    return written(few).unionByName(written(many.withColumn("__chunk", F.col("__chunk").cast("int"))))


def inventory_ledger(
    products: DataFrame,
    items: DataFrame,
    arrival: Sequence[str] = ARRIVAL,
    unique: bool = True,
) -> DataFrame:
    """Stock after each line, and whether the line is the first to oversell."""
    lines = items.select(*line_columns(arrival))
    stock = products.select("product_id", "stock_quantity")
    left = F.col("stock_quantity") - F.col("sold_upto")
    return (
        running_sales(lines, arrival, unique)
        .join(stock, "product_id")
        .select(
            *lines.columns,
            left.alias("stock_after"),
            (left < 0).alias("oversold"),
            ((left < 0) & (left + F.col("quantity") >= 0)).alias("first_oversell"),
        )
    )


def sale_impact(products: DataFrame, items: DataFrame) -> DataFrame:
    """What a batch of lines does to every product, and whether it is accepted.

    One product below zero refuses the whole batch, and stock stays as it was.
    """
    sold = items.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    stock = products.select("product_id", "stock_quantity")
    after = F.col("stock_quantity") - F.coalesce("units_sold", F.lit(0))
    impact = stock.join(sold, "product_id", "left").select(
        "product_id",
        F.col("stock_quantity").alias("stock_before"),
        F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
        after.alias("stock_if_applied"),
    )
    accepted = impact.agg(F.count_if(F.col("stock_if_applied") < 0) == 0).scalar()
    return impact.withColumn("batch_accepted", accepted).withColumn(
        "stock_after",
        F.when(F.col("batch_accepted"), F.col("stock_if_applied")).otherwise(
            F.col("stock_before")
        ),
    )


def apply_sales(products: DataFrame, items: DataFrame) -> DataFrame:
    """Products with the batch deducted; raises when any product would go below zero.

    The joined stock is stored once: the check and the answer read the same
    rows. The error names the first product and says how many are short.
    """
    sold = items.groupBy("product_id").agg(F.sum("quantity").alias("__sold"))
    left = F.col("stock_quantity") - F.coalesce("__sold", F.lit(0))
    joined = materialize(
        products.join(sold, "product_id", "left").withColumn("__left", left), "stock-after"
    )
    short = joined.filter("__left < 0").agg(
        F.count("*").alias("n"), F.min("product_id").alias("first")
    ).first()
    if short["n"]:
        raise InsufficientInventory(
            f"Insufficient inventory for product_id: {short['first']}"
            f" (products short in all: {short['n']})"
        )
    kind = products.schema["stock_quantity"].dataType
    return joined.withColumn("stock_quantity", F.col("__left").cast(kind)).select(*products.columns)
