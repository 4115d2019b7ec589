"""Bulk load: CSV files to checked Parquet tables and the first mart build.

A line that cannot be read as a row of its table stops the load, as in the bulk
load that this replaces, or is put in quarantine: it becomes a rejected row
that carries the line itself and the file it stands in. Every line of a file
is then an accepted or a rejected row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.operators.constraints import (
    REASONS,
    Unique,
    flag_violations,
    row_rules,
    table_rules,
)
from cartwright.plans.mart import publish_mart
from cartwright.runtime import materialize, temporary_tables
from cartwright.sources import schemas as S
from cartwright.sources.csv_files import CORRUPT, load_csv

# Parents come before the tables that refer to them.
LOAD_ORDER = [
    "categories", "products", "customers", "orders", "order_items", "payments", "reviews",
]


ACCEPTED = "accepted"
UNREADABLE = "line cannot be read"
#: An unreadable line and its file; NULL in all other rows.
REJECTED_LINE = "rejected_line"
REJECTED_FILE = "rejected_file"


def _stored(spark: SparkSession, out_dir: str, table: str, schema: T.StructType) -> DataFrame:
    kept = [*schema.fields, T.StructField(REASONS, T.ArrayType(T.StringType()))]
    kept += [T.StructField(c, T.StringType()) for c in (REJECTED_LINE, REJECTED_FILE)]
    known = T.StructType([*kept, T.StructField(ACCEPTED, T.BooleanType())])
    return spark.read.schema(known).parquet(f"{out_dir}/{table}")


def read_table(spark: SparkSession, out_dir: str, table: str, schema: T.StructType) -> DataFrame:
    """The accepted rows of a loaded table; files of rejected rows are not read."""
    known = _stored(spark, out_dir, table, schema).filter(ACCEPTED)
    return known.drop(ACCEPTED, REASONS, REJECTED_LINE, REJECTED_FILE)


def read_rejected(spark: SparkSession, out_dir: str, table: str, schema: T.StructType) -> DataFrame:
    """The rejected rows of a loaded table with their reasons, and the lines of those that could not be read."""
    return _stored(spark, out_dir, table, schema).filter(~F.col(ACCEPTED)).drop(ACCEPTED)


def _set_aside(rows: DataFrame) -> DataFrame:
    """Rows of ``load_csv(keep_corrupt=True)``: those of unreadable lines hold the line and its file alone."""
    readable = F.col(CORRUPT).isNull()
    own = [F.when(readable, F.col(c)).alias(c) for c in rows.columns if c != CORRUPT]
    file = F.when(~readable, F.col("_metadata.file_path"))
    return rows.select(*own, F.col(CORRUPT).alias(REJECTED_LINE), file.alias(REJECTED_FILE))


@contextmanager
def _both_open(spark: SparkSession) -> Iterator[None]:
    """Tasks keep the files of accepted and of rejected rows open at once, instead of sorting their rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def load_tables(
    spark: SparkSession, csv_dir: str, out_dir: str, *, check_references: bool = False, quarantine: bool = False
) -> dict[str, DataFrame]:
    """Load the seven CSV tables into ``out_dir`` and build the mart.

    The lines of a table are read once and its rows kept aside until they are
    flagged and written, partitioned by whether a row was accepted; rejected
    rows carry their reasons. A second load replaces the first. As in the bulk
    load this replaces, references are not checked unless asked for; the
    data-quality checks find orphans afterwards. With ``quarantine`` lines of
    the wrong shape or type are rejected rows as well and break no other rule;
    without it one of them stops the load.
    """
    tables: dict[str, DataFrame] = {}
    for table in LOAD_ORDER:
        rows = load_csv(spark, f"{csv_dir}/{table}.csv", table, keep_corrupt=quarantine)
        schema = T.StructType([f for f in rows.schema.fields if f.name != CORRUPT])
        rows = _set_aside(rows) if quarantine else rows
        with temporary_tables(spark), _both_open(spark):
            # Reading lines is most of the work; each rule on keys reads the rows again.
            rows = materialize(rows, f"{table}-rows")
            # A table may refer to itself, so its own rows are known as well.
            rules = (
                table_rules(table, {**tables, table: rows})
                if check_references
                else [*row_rules(table), *[Unique((c,)) for c in S.UNIQUE_KEYS[table]]]
            )
            flagged = flag_violations(rows, rules)
            if quarantine:
                unread = F.when(F.col(REJECTED_LINE).isNotNull(), F.array(F.lit(UNREADABLE)))
                flagged = flagged.withColumn(REASONS, F.coalesce(unread, REASONS))
            flagged = flagged.withColumn(ACCEPTED, F.size(REASONS) == 0)
            flagged.write.mode("overwrite").partitionBy(ACCEPTED).parquet(f"{out_dir}/{table}")
        tables[table] = read_table(spark, out_dir, table, schema)
    publish_mart(spark, tables["orders"], tables["order_items"], f"{out_dir}/mart")
    return tables
