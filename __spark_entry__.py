"""Registered queries: names, plans and the SQL each is compared with."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwright.functions import labels as L
from cartwright.functions import money
from cartwright.operators import constraints as C
from cartwright.operators import deletion, inventory, quality
from cartwright.operators.ranking import distributed_running_sum
from cartwright.plans import cohorts, customers, finance, logistics, mart, payments, products
from cartwright.plans import reports as R
from cartwright.runtime import fresh_path, materialize
from cartwright.sources import (
    StarTables,
    load_csv,
    load_generated_column,
    write_bucketed,
    write_csv,
    write_orders_by_customer,
    write_orders_by_status,
)
from cartwright.sources.loading import LOAD_ORDER, REJECTED_LINE, UNREADABLE, load_tables, read_rejected
from cartwright.sources.schemas import DEFAULTS, NOW, SCHEMAS
from cartwright.sources.star_tables import LINE_ARRIVAL
from cartwright.streaming import (
    inventory_stream,
    monthly_buyers_stream,
    monthly_stream,
    read_monthly_buyers,
    stock_levels,
)
from oracle import ORACLE
from oracle.faults import FAULTS

try:
    from cartwright.llm.queries import ORACLE as LLM_ORACLE
    from cartwright.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    # The training-data subpackage, its pipeline file included, may be left out; any other missing module is a fault.
    if missing.name not in ("cartwright.llm", "cartwright.llm.queries", "corpus_pipeline"):
        raise
    LLM_ORACLE, LLM_QUERIES = {}, {}

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.datetime(2001, 1, 1)
CELLS_AS_OF = datetime.date(2001, 12, 31)
TIMELINE_CUSTOMER = 100
TIMELINE_SINCE = datetime.datetime(1997, 1, 1)
# Order lines and orders reach the streams in slices up to these dates.
# Orders for which LATE holds reach order-independent streams after all others.
LATE = "order_id % 50 = 7"
BUCKETS = 16
# Units added to every product so that all sales together can be served.
RESTOCK = 10_000_000
SLICE_ENDS = [datetime.datetime(1997, 1, 1), datetime.datetime(1999, 1, 1), None]


def _plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles and all integers as bigint, for comparison."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select([column(f) for f in df.schema.fields])


# ---------------------------------------------------------------- reports


def _monthly_kpis(t: StarTables) -> DataFrame:
    return finance.monthly_kpis(t.orders(), t.order_items())


def _channels(t: StarTables) -> DataFrame:
    return finance.channel_performance(t.customers(), t.orders())


def _rfm(t: StarTables) -> DataFrame:
    return customers.rfm_scores(t.customers(), t.orders())


def _segments(t: StarTables) -> DataFrame:
    return customers.rfm_segments(_rfm(t))


def _matrix(t: StarTables) -> DataFrame:
    return cohorts.cohort_retention_matrix(cohorts.cohort_retention_long(t.orders()))


def _star(t: StarTables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return t.products(), t.categories(), t.order_items(), t.orders()


def _pareto(t: StarTables) -> DataFrame:
    return products.product_pareto(*_star(t))


def _sla(t: StarTables) -> DataFrame:
    return logistics.delivery_sla_by_state(t.orders(with_state=True))


def _returns(t: StarTables) -> DataFrame:
    return products.product_return_vs_rating(*_star(t), t.reviews())


def _order_details(t: StarTables) -> DataFrame:
    return logistics.order_details(
        t.orders(), t.customers(with_state=True), t.order_items(), t.products(), t.categories()
    )


def _format_money(t: StarTables) -> DataFrame:
    balance = F.col("total_amount") - 50000
    return t.orders().select("order_id", money(balance).alias("balance_text"))


# ------------------------------------------- scale forms under their own names


def _distributed_ntile(t: StarTables) -> DataFrame:
    return _rfm(t).select("customer_id", "r_score", "f_score", "m_score")


def _distributed_running_sum(t: StarTables) -> DataFrame:
    sales = materialize(products.product_sales(*_star(t)), "product-sales")
    return distributed_running_sum(
        sales,
        "total_revenue",
        "total_revenue",
        running="cumulative_revenue",
        total="overall_revenue",
        rank="revenue_rank",
    ).select("product_id", "cumulative_revenue", "overall_revenue", "revenue_rank")


def _distributed_percentiles(t: StarTables) -> DataFrame:
    return _sla(t)


# ------------------------------------------------------- sources and sinks


def _load_csv(t: StarTables) -> DataFrame:
    path = fresh_path(t.spark, "orders-csv")
    orders = t.orders(with_state=True).withColumn(
        "shipping_postal_code", F.lit(None).cast("string")
    )
    write_csv(orders.select(SCHEMAS["orders"].names), path)
    loaded = load_csv(t.spark, path, "orders")

    def utc(name: str):
        at = F.to_utc_timestamp(name, F.current_timezone())
        return F.date_format(at, "yyyy-MM-dd HH:mm:ss")

    return loaded.withColumns({c: utc(c) for c in ("order_date", "delivery_date")})


def _csv_tables(t: StarTables) -> dict[str, DataFrame]:
    """The seven tables as CSV exports; some channels and methods are unknown, some defaulted fields blank."""

    def one_of(names: list[str], key: str) -> Column:
        known = F.array(*[F.lit(n) for n in [*names, "unknown"]])
        return F.element_at(known, (F.col(key) % (len(names) + 1) + 1).cast("int"))

    blank = F.lit(None).cast("string")
    extra = {
        "customers": {
            "acquisition_channel": one_of(L.ACQUISITION_CHANNELS, "customer_id"),
            "phone": blank, "postal_code": blank, "country": blank,
        },
        "categories": {"parent_category_id": blank, "description": blank},
        "products": {"created_at": blank},
        "orders": {"shipping_postal_code": blank},
        "order_items": {"order_item_id": F.expr("order_id * 10 + line_number")},
        "payments": {"payment_method": one_of(L.PAYMENT_METHODS, "order_id")},
        "reviews": {"review_title": blank, "review_text": blank, "is_verified_purchase": blank},
    }
    tables = t.all() | {"customers": t.customers(with_state=True), "orders": t.orders(with_state=True)}
    return {
        name: tables[name].withColumns(extra[name]).select(SCHEMAS[name].names) for name in LOAD_ORDER
    }


def _load_tables(t: StarTables) -> DataFrame:
    """The whole bulk load: accepted and rejected rows of each of the seven tables."""
    path = fresh_path(t.spark, "bulk-load")
    for name, table in _csv_tables(t).items():
        write_csv(table, f"{path}/in/{name}.csv")
    loaded = load_tables(t.spark, f"{path}/in", f"{path}/out")
    counts = [
        table.select(F.lit(1).alias("ok"))
        .unionByName(read_rejected(t.spark, f"{path}/out", name, table.schema).select(F.lit(0).alias("ok")))
        .agg(F.count_if(F.col("ok") == 1).alias("accepted"), F.count_if(F.col("ok") == 0).alias("rejected"))
        .select(F.lit(name).alias("table_name"), "accepted", "rejected")
        for name, table in loaded.items()
    ]
    return reduce(DataFrame.unionByName, counts)


#: Lines that cannot be read, by table: which rows they are, the column and what stands in it.
UNREADABLE_LINES = {
    "customers": ("customer_id % 83 = 5", "created_at", "yesterday"),
    "products": ("product_id % 79 = 5", "sale_price", "12,50 EUR"),
    "orders": ("order_id % 97 = 5", "total_amount", "n/a"),
    "order_items": ("order_id % 89 = 5", "quantity", "many"),
    "payments": ("order_id % 101 = 5", "payment_id", "#"),
    "reviews": ("review_id % 73 = 5", "rating", "good"),
}


def _load_tables_quarantined(t: StarTables) -> DataFrame:
    """The bulk load of files with unreadable lines: accepted, rejected and, of these, unreadable rows."""
    path = fresh_path(t.spark, "quarantine")
    for name, table in _csv_tables(t).items():
        if name in UNREADABLE_LINES:
            rows, column, text = UNREADABLE_LINES[name]
            kind = table.schema[column].dataType
            value = F.col(column)
            if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                value = F.date_format(value, "yyyy-MM-dd HH:mm:ss'+00'")
            table = table.withColumn(column, F.when(F.expr(rows), text).otherwise(value.cast("string")))
        write_csv(table, f"{path}/in/{name}.csv")
    loaded = load_tables(t.spark, f"{path}/in", f"{path}/out", quarantine=True)
    counts = []
    for name, table in loaded.items():
        refused = read_rejected(t.spark, f"{path}/out", name, table.schema)
        unread = F.array_contains(C.REASONS, UNREADABLE) & F.col(REJECTED_LINE).isNotNull()
        rows = table.select(F.lit(True).alias("ok"), F.lit(False).alias("unread"))
        rows = rows.unionByName(refused.select(F.lit(False).alias("ok"), unread.alias("unread")))
        counts.append(
            rows.agg(
                F.count_if("ok").alias("accepted"),
                F.count_if(~F.col("ok")).alias("rejected"),
                F.count_if("unread").alias("unreadable"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, counts)


def _load_defaults(t: StarTables) -> DataFrame:
    """What stands in each defaulted column, after a load of files that leave it blank in every tenth row.

    A default of the load's own time reads as "now".
    """
    path = fresh_path(t.spark, "defaults")
    found = []
    for name, table in _csv_tables(t).items():
        if not DEFAULTS[name]:
            continue
        key = table.columns[0]
        blank = {c: F.when(F.col(key) % 10 != 3, F.col(c)) for c in DEFAULTS[name]}
        write_csv(table.withColumns(blank), f"{path}/{name}.csv")
        loaded = load_csv(t.spark, f"{path}/{name}.csv", name).filter(F.col(key) % 10 == 3)

        def value(column: str):
            if DEFAULTS[name][column] is not NOW:
                return F.col(column).cast("string")
            age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds(column)
            return F.when(F.abs(age) < 86400, "now").otherwise("another time")

        entries = [F.struct(F.lit(c).alias("column_name"), value(c).alias("value")) for c in DEFAULTS[name]]
        found.append(
            loaded.select(F.inline(F.array(*entries))).groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))
            .select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, found)


def _write_csv(t: StarTables) -> DataFrame:
    path = fresh_path(t.spark, "products-csv")
    table = t.products()
    write_csv(table, path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in table.columns])
    return t.spark.read.schema(text).option("header", True).option("escape", '"').csv(path)


def _load_generated_column(t: StarTables) -> DataFrame:
    return load_generated_column(t.order_items().drop("total_price")).select(
        "order_id",
        "line_number",
        "product_id",
        "quantity",
        "unit_price",
        "item_discount",
        "total_price",
    )


def _orders_by_status(t: StarTables) -> DataFrame:
    path = fresh_path(t.spark, "orders-by-status")
    write_orders_by_status(t.orders(), path)
    return logistics.active_orders(t.spark.read.parquet(path))


def _orders_by_customer(t: StarTables) -> DataFrame:
    path = fresh_path(t.spark, "orders-by-customer")
    write_orders_by_customer(t.orders(), path)
    stored = t.spark.read.parquet(path)
    return logistics.customer_timeline(stored, TIMELINE_CUSTOMER, TIMELINE_SINCE)


def _monthly_kpis_by_buckets(t: StarTables) -> DataFrame:
    """Orders and lines in equal buckets by order: they meet without a shuffle."""
    stored = [
        write_bucketed(table, "order_id", BUCKETS, fresh_path(t.spark, "by-order"))
        for table in (t.orders(), t.order_items())
    ]
    return finance.monthly_kpis(*stored)


def _customer_timeline_by_buckets(t: StarTables) -> DataFrame:
    """Orders in buckets by customer: one bucket is read."""
    path = fresh_path(t.spark, "by-customer")
    stored = write_bucketed(t.orders(), "customer_id", BUCKETS, path, order=["order_date", "order_id"])
    return logistics.customer_timeline(stored, TIMELINE_CUSTOMER, TIMELINE_SINCE)


def _delivery_sketches(t: StarTables) -> DataFrame:
    """Sketches of all deliveries, some of them added late, against the true ranks."""
    root = fresh_path(t.spark, "delivery-sketches")
    orders = t.orders(with_state=True)
    logistics.add_deliveries(t.spark, orders.filter(f"NOT ({LATE})"), root)
    logistics.add_deliveries(t.spark, orders.filter(LATE), root)
    return logistics.delivery_percentile_misses(orders, logistics.delivery_percentiles(t.spark, root))


# -------------------------------------------------------------------- mart


def _write_mart(t: StarTables) -> DataFrame:
    path = fresh_path(t.spark, "mart")
    mart.write_mart(finance.monthly_mart(t.orders(), t.order_items()), path)
    return t.spark.read.parquet(path)


def _mart_dashboard(t: StarTables) -> DataFrame:
    return finance.mart_dashboard(_write_mart(t))


def _refresh_mart(t: StarTables) -> DataFrame:
    root = fresh_path(t.spark, "mart")
    for _ in range(2):
        mart.refresh_mart(t.spark, t.orders(), t.order_items(), root)
    return mart.read_mart(t.spark, root)


def _refresh_mart_incremental(t: StarTables) -> DataFrame:
    root = fresh_path(t.spark, "mart")
    late = F.col("order_date") >= F.lit(datetime.date(2000, 6, 1))
    mart.publish_mart(t.spark, t.orders().filter(~late), t.order_items(), root)
    changed = t.orders().filter(late)
    mart.refresh_mart_incremental(t.spark, t.orders(), t.order_items(), changed, root)
    return mart.read_mart(t.spark, root)


# ----------------------------------------------------------------- quality


def _seeded(t: StarTables) -> dict[str, DataFrame]:
    """The seven tables with planted faults of every kind that the checks look for."""
    tables = t.all()
    return {
        name: table.selectExpr(
            *[f"{FAULTS[name][c]} AS {c}" if c in FAULTS.get(name, {}) else c for c in table.columns]
        )
        for name, table in tables.items()
    }


# ------------------------------------------------------------- constraints


def _flagged(df: DataFrame, rules: list, *columns: str) -> DataFrame:
    reasons = F.array_join(C.REASONS, "; ").alias("reasons")
    return C.flag_violations(df, rules).select(*columns, reasons)


def _enforce_not_null(t: StarTables) -> DataFrame:
    return _flagged(t.orders(), [C.NotNull("delivery_date")], "order_id")


def _enforce_unique(t: StarTables) -> DataFrame:
    rule = C.Unique(("order_id", "line_number"))
    columns = ["order_id", "line_number", "product_id", "quantity"]
    return _flagged(t.order_items().select(*columns), [rule], *columns)


def _enforce_fk(t: StarTables) -> DataFrame:
    rule = C.ForeignKey("product_id", t.products().filter("is_active"), "product_id")
    columns = ["order_id", "line_number", "product_id"]
    return _flagged(t.order_items().select(*columns), [rule], *columns)


def _enforce_check(t: StarTables) -> DataFrame:
    limit = F.expr("0.05BD * quantity * unit_price")
    rules = [
        C.Check("quantity is over 40", F.col("quantity") <= 40),
        C.Check("discount is over 5%", F.col("item_discount") <= limit),
    ]
    return _flagged(t.order_items(), rules, "order_id", "line_number", "product_id", "quantity")


def _faulty_orders(t: StarTables) -> DataFrame:
    """All orders, some with one fault or more of every kind that the order table's rules know."""

    def where(fault: int, column: str, value: str) -> str:
        return f"CASE WHEN order_id % {fault} = 3 THEN {value} ELSE {column} END AS {column}"

    orders = t.orders(with_state=True).selectExpr(
        "order_id",
        where(101, "customer_id", "CAST(NULL AS BIGINT)").replace(
            "ELSE", "WHEN order_id % 107 = 3 THEN -1 ELSE"
        ),
        "order_date",
        where(97, "order_status", "'lost'"),
        "subtotal_amount",
        "shipping_fee",
        "discount_amount",
        where(113, "total_amount", "CAST(-1 AS DECIMAL(12,2))"),
        where(103, "shipping_city", "repeat('x', 61)"),
        "shipping_state",
        "CAST(NULL AS STRING) AS shipping_postal_code",
        where(127, "delivery_date", "order_date - INTERVAL '1' DAY"),
    )
    return orders.unionByName(orders.filter("order_id % 109 = 3"))


def _enforce_table_rules(t: StarTables) -> DataFrame:
    """One row per violated rule of the order table: order and reason."""
    rules = C.table_rules("orders", {"customers": t.customers()})
    return C.flag_violations(_faulty_orders(t), rules).select(
        "order_id", F.explode(C.REASONS).alias("reason")
    )


def _delete_propagation(t: StarTables) -> DataFrame:
    gone = t.orders().filter("order_status = 'cancelled'").select("order_id")

    def summary(child: str, action: str, affected, kept) -> list:
        return [
            F.lit(child).alias("child"),
            F.lit(action).alias("action"),
            affected.alias("affected_rows"),
            kept.alias("kept_rows"),
        ]

    def cascade(child: str, table: DataFrame) -> DataFrame:
        before = table.agg(F.count("*")).scalar()
        left = C.cascade_delete(table.select("order_id"), "order_id", gone, "order_id")
        kept = left.agg(F.count("*").alias("kept"))
        return kept.select(summary(child, "cascade", before - F.col("kept"), F.col("kept")))

    cleared = C.set_null_on_delete(t.reviews(), "order_id", gone, "order_id").agg(
        F.count_if(F.col("order_id").isNull()).alias("cleared"), F.count("*").alias("rows")
    )
    leaving = t.customers().filter("acquisition_channel = 'BUILDING'")
    blocking = C.restricting_rows(
        t.orders().select("customer_id"), "customer_id", leaving, "customer_id"
    ).agg(F.count("*").alias("blocking"))
    return (
        cascade("order_items", t.order_items())
        .unionByName(cascade("payments", t.payments()))
        .unionByName(
            cleared.select(summary("reviews", "set_null", F.col("cleared"), F.col("rows")))
        )
        .unionByName(
            blocking.select(
                summary(
                    "orders",
                    "restrict",
                    F.col("blocking"),
                    t.orders().agg(F.count("*")).scalar(),
                )
            )
        )
    )


def _tables_with_category_tree(t: StarTables) -> dict[str, DataFrame]:
    """All tables; category n lies below category n div 2."""
    parent = F.expr("nullif(category_id div 2, 0)").alias("parent_category_id")
    return t.all() | {"categories": t.categories().select("category_id", "category_name", parent)}


def _closure(t: StarTables, references: list[deletion.Reference]) -> DataFrame:
    tables = _tables_with_category_tree(t)
    chosen = {
        "customers": tables["customers"].filter("acquisition_channel = 'BUILDING'"),
        "categories": tables["categories"].filter("category_id = 2"),
    }
    keys = {"order_items": "order_id"}
    return deletion.delete_closure(tables, chosen, references=references, keys=keys).summary()


def _delete_closure(t: StarTables) -> DataFrame:
    """With the references of the schema: orders and products forbid the deletion."""
    return _closure(t, deletion.schema_references())


def _delete_closure_cascading(t: StarTables) -> DataFrame:
    """A purge: subcategories, products and orders go as well; lines of deleted products forbid it."""
    purged = ("parent_category_id", "category_id", "customer_id")
    references = [
        replace(r, action="cascade") if r.column in purged else r for r in deletion.schema_references()
    ]
    return _closure(t, references)


# --------------------------------------------------------------- inventory


def _ledger(t: StarTables) -> DataFrame:
    return inventory.inventory_ledger(t.products(), t.order_items(), LINE_ARRIVAL, unique=False)


def _apply_sales(t: StarTables) -> DataFrame:
    """All lines as one batch against a restocked warehouse, which takes them."""
    stocked = t.products().withColumn("stock_quantity", F.col("stock_quantity").cast("bigint") + RESTOCK)
    return inventory.apply_sales(stocked, t.order_items()).select("product_id", "stock_quantity")


def _apply_sales_refused(t: StarTables) -> DataFrame:
    """The same batch against the stock at hand, which one product at least cannot serve."""
    goods = t.products()
    try:
        left, refused = inventory.apply_sales(goods, t.order_items()), False
    except inventory.InsufficientInventory:
        left, refused = goods, True
    return left.select("product_id", "stock_quantity", F.lit(refused).alias("refused"))


# --------------------------------------------------------------- streaming


def _stream_slices(
    df: DataFrame, when: str, label: str, start: Callable[[DataFrame], StreamingQuery], late: str = "false"
) -> None:
    """File stream over the whole table: one micro-batch for each slice of time, however many files hold it.

    A slice arrives, ``start`` starts the query on the stream, and the query
    goes on from its checkpoint until it has taken the slice. Rows without a
    time come first; rows that ``late`` holds for come last, whatever their
    time.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    slice_no = F.when(F.expr(late), len(SLICE_ENDS))
    for number, end in enumerate(SLICE_ENDS):
        ends = F.lit(True) if end is None else F.col(when) < F.lit(end.date())
        slice_no = slice_no.when(F.col(when).isNull() | ends, number)
    for number in range(len(SLICE_ENDS) + (late != "false")):
        df.filter(slice_no == number).write.mode("append").parquet(path)
        start(spark.readStream.schema(df.schema).parquet(path)).awaitTermination()


def _inventory_stream(t: StarTables) -> DataFrame:
    sink = fresh_path(t.spark, "ledger")
    lines = t.order_items().select(inventory.line_columns(LINE_ARRIVAL))

    def start(arriving: DataFrame) -> StreamingQuery:
        return inventory_stream(
            arriving, t.products(), sink, f"{sink}-checkpoint", arrival=LINE_ARRIVAL, unique=False
        )

    _stream_slices(lines, "created_at", "lines", start)
    return t.spark.read.parquet(f"{sink}/ledger").drop("batch")


def _stock_levels_stream(t: StarTables) -> DataFrame:
    sink = fresh_path(t.spark, "stock")
    columns = t.order_items().select("order_id", "product_id", "quantity", "created_at")

    def start(lines: DataFrame) -> StreamingQuery:
        return (
            stock_levels(lines, t.products())
            .writeStream.outputMode("update")
            .foreachBatch(
                lambda batch, number: batch.withColumn("batch_no", F.lit(number).cast("bigint"))
                .write.mode("overwrite")
                .parquet(f"{sink}/batch={number}")
            )
            .option("checkpointLocation", f"{sink}-checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    _stream_slices(columns, "created_at", "lines", start, late=LATE)
    updates = t.spark.read.parquet(sink)
    newest = updates.groupBy("product_id").agg(
        F.max_by(F.struct("units_sold", "stock_left", "oversold"), "batch_no").alias("s")
    )
    return newest.select("product_id", "s.units_sold", "s.stock_left", "s.oversold")


def _monthly_stream(t: StarTables) -> DataFrame:
    root = fresh_path(t.spark, "monthly")

    def start(orders: DataFrame) -> StreamingQuery:
        return monthly_stream(orders, root, f"{root}-checkpoint")

    _stream_slices(t.orders(), "order_date", "orders", start, late=LATE)
    return mart.read_mart(t.spark, root)


def _monthly_buyers_stream(t: StarTables) -> DataFrame:
    """Distinct buyers too; every fiftieth order comes after all others, whatever its month."""
    root = fresh_path(t.spark, "monthly-buyers")

    def start(orders: DataFrame) -> StreamingQuery:
        return monthly_buyers_stream(orders, root, f"{root}-checkpoint")

    _stream_slices(t.orders(), "order_date", "orders", start, late=LATE)
    return read_monthly_buyers(t.spark, root)


PLANS: dict[str, Callable[[StarTables], DataFrame]] = {
    # finance
    "monthly_kpis": _monthly_kpis,
    "monthly_kpis_order_grain": lambda t: finance.monthly_kpis_order_grain(
        t.orders(), t.order_items()
    ),
    "monthly_kpis_report": lambda t: R.print_monthly_kpis(_monthly_kpis(t)),
    "channel_performance": _channels,
    "channel_performance_report": lambda t: R.print_channel_performance(_channels(t)),
    "monthly_mart": lambda t: finance.monthly_mart(t.orders(), t.order_items()),
    "mart_dashboard": _mart_dashboard,
    # customers and cohorts
    "rfm_scores": _rfm,
    "rfm_segments": _segments,
    "rfm_segments_report": lambda t: R.print_rfm_segments(_segments(t)),
    "rfm_score_cells": lambda t: customers.rfm_score_cells(t.customers(), t.orders(), CELLS_AS_OF),
    "revenue_at_risk": lambda t: customers.revenue_at_risk(_segments(t)),
    "cohort_retention_long": lambda t: cohorts.cohort_retention_long(t.orders()),
    "cohort_retention_matrix": _matrix,
    "cohort_retention_matrix_report": lambda t: R.print_cohort_matrix(_matrix(t)),
    "retention_curve": lambda t: cohorts.retention_curve(cohorts.cohort_retention_long(t.orders())),
    # products
    "product_pareto": _pareto,
    "product_pareto_report": lambda t: R.print_product_pareto(_pareto(t)),
    "pareto_tier_summary": lambda t: products.pareto_tier_summary(_pareto(t)),
    "pareto_top": lambda t: products.pareto_top(*_star(t)),
    "product_return_vs_rating": _returns,
    "product_return_vs_rating_report": lambda t: R.print_return_vs_rating(_returns(t)),
    "catalog_search": lambda t: products.catalog_search(t.products(), "GIZ"),
    "low_stock_products": lambda t: products.low_stock_products(t.products()),
    # logistics and payments
    "delivery_sla_by_state": _sla,
    "delivery_sla_by_state_report": lambda t: R.print_delivery_sla(_sla(t)),
    "delivery_sla_national": lambda t: logistics.delivery_sla_national(t.orders()),
    "order_status_pipeline": lambda t: logistics.order_status_pipeline(t.orders()),
    "order_status_pipeline_report": lambda t: R.print_status_pipeline(
        logistics.order_status_pipeline(t.orders())
    ),
    "active_orders": lambda t: logistics.active_orders(t.orders()),
    "active_orders_by_layout": _orders_by_status,
    "customer_timeline": lambda t: logistics.customer_timeline(
        t.orders(), TIMELINE_CUSTOMER, TIMELINE_SINCE
    ),
    "customer_timeline_by_layout": _orders_by_customer,
    "customer_timeline_by_buckets": _customer_timeline_by_buckets,
    "monthly_kpis_by_buckets": _monthly_kpis_by_buckets,
    "delivery_percentile_sketches": _delivery_sketches,
    "order_details": _order_details,
    "payment_method_health": lambda t: payments.payment_method_health(t.payments()),
    "payment_method_health_report": lambda t: R.print_payment_health(
        payments.payment_method_health(t.payments())
    ),
    "payment_method_share": lambda t: payments.payment_method_share(t.payments()),
    "format_money": _format_money,
    # quality and constraints
    "dq_orphans": lambda t: quality.dq_orphans(t.all()),
    "dq_checks": lambda t: quality.dq_checks(t.all(), AS_OF),
    "dq_duplicates": lambda t: quality.dq_duplicates(t.all()),
    "dq_scorecard": lambda t: quality.dq_scorecard(t.all(), AS_OF),
    "dq_orphans_seeded": lambda t: quality.dq_orphans(_seeded(t)),
    "dq_checks_seeded": lambda t: quality.dq_checks(_seeded(t), AS_OF),
    # By the clock: planted dates are decades away from it on both sides.
    "dq_checks_by_clock": lambda t: quality.dq_checks(_seeded(t)),
    "dq_duplicates_seeded": lambda t: quality.dq_duplicates(_seeded(t)),
    "dq_scorecard_seeded": lambda t: quality.dq_scorecard(_seeded(t), AS_OF),
    "enforce_not_null": _enforce_not_null,
    "enforce_unique": _enforce_unique,
    "enforce_fk": _enforce_fk,
    "enforce_check": _enforce_check,
    "enforce_table_rules": _enforce_table_rules,
    "delete_propagation": _delete_propagation,
    "delete_closure": _delete_closure,
    "delete_closure_cascading": _delete_closure_cascading,
    # sources, sinks and the mart
    "load_csv": _load_csv,
    "load_tables": _load_tables,
    "load_tables_quarantined": _load_tables_quarantined,
    "load_defaults": _load_defaults,
    "load_generated_column": _load_generated_column,
    "write_csv": _write_csv,
    "write_mart": _write_mart,
    "refresh_mart": _refresh_mart,
    "refresh_mart_incremental": _refresh_mart_incremental,
    # inventory
    "inventory_ledger": _ledger,
    "inventory_ledger_distributed": _ledger,
    "sale_impact": lambda t: inventory.sale_impact(t.products(), t.order_items()),
    "apply_sales": _apply_sales,
    "apply_sales_refused": _apply_sales_refused,
    # scale forms
    "distributed_ntile": _distributed_ntile,
    "distributed_running_sum": _distributed_running_sum,
    "distributed_percentiles": _distributed_percentiles,
    # streaming
    "inventory_stream": _inventory_stream,
    "stock_levels_stream": _stock_levels_stream,
    "monthly_stream": _monthly_stream,
    "monthly_buyers_stream": _monthly_buyers_stream,
}


def _query(plan: Callable[[StarTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(plan(StarTables(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: _query(plan) for name, plan in PLANS.items()} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return {name: ORACLE[name] for name in PLANS if name in ORACLE} | LLM_ORACLE


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly financial KPIs with growth."""
    return queries()["monthly_kpis"](spark, "/root/testdata/sf0.001")
