"""CSV in and out, with the dialect of the retail exports.

Header row, comma, doubled quotes inside quoted text, empty field = NULL,
booleans as TRUE/FALSE, timestamps in UTC with a ``+00`` suffix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.sources.schemas import DEFAULTS, NOW, SCHEMAS

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]X"
CORRUPT = "_corrupt_record"


def load_csv(
    spark: SparkSession,
    path: str,
    table: str,
    *,
    multi_line: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read one retail table.

    Rows that do not parse fail the read, as a bulk load does, unless
    ``keep_corrupt`` asks for them in a ``_corrupt_record`` column.
    ``multi_line`` accepts line breaks inside quoted text, but then a file
    cannot be split between tasks, so it is off by default.
    """
    schema = SCHEMAS[table]
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    loaded = _with_defaults(raw, table)
    return load_generated_column(loaded) if table == "order_items" else loaded


def _with_defaults(df: DataFrame, table: str) -> DataFrame:
    filled = {
        column: F.coalesce(
            F.col(column), F.current_timestamp() if value is NOW else F.lit(value)
        ).cast(df.schema[column].dataType)
        for column, value in DEFAULTS[table].items()
    }
    return df.withColumns(filled) if filled else df


def load_generated_column(items: DataFrame) -> DataFrame:
    """Add ``total_price``, which files do not carry."""
    total = F.col("quantity") * F.col("unit_price") - F.col("item_discount")
    return items.withColumn("total_price", total.cast("decimal(12,2)"))


def write_csv(df: DataFrame, path: str) -> None:
    """Export ``df``, one file per partition: money with two decimals, UTC timestamps."""
    df.select([_as_text(f) for f in df.schema.fields]).write.option("header", True).option(
        "escape", '"'
    ).csv(path)


def _as_text(field: T.StructField):
    column = F.col(field.name)
    if isinstance(field.dataType, T.DecimalType) and field.dataType.scale == 2:
        text = column.cast("string")
    elif isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
        text = F.round(column, 2).cast("decimal(38,2)").cast("string")
    elif isinstance(field.dataType, T.BooleanType):
        text = F.upper(column.cast("string"))
    elif isinstance(field.dataType, T.TimestampNTZType):
        text = F.concat(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
    elif isinstance(field.dataType, T.TimestampType):
        utc = F.to_utc_timestamp(column, F.current_timezone())
        text = F.concat(F.date_format(utc, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
    else:
        text = column.cast("string")
    return text.alias(field.name)
