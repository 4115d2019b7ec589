"""Column helpers for texts, lines and words."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters of ``[\x20\x09-\x0D]``.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """Number in [0, 1) drawn from the first 52 bits of an MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def packed(docs: DataFrame) -> Column:
    """All columns of a row in one struct, safe from clashes with an operator's own names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(df: DataFrame, row: str, replaced: dict[str, Column] | None = None) -> DataFrame:
    """The columns of a ``packed`` row again, some with new values."""
    replaced = replaced or {}
    names = df.schema[row].dataType.names
    return df.select(
        *[replaced.get(c, F.col(row).getField(c)).alias(c) for c in names]
    )
