"""Text formats of the printed reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_text(*parts: Column) -> Column:
    """Concatenate as text, skipping NULL parts."""
    return F.concat_ws("", *[p.cast("string") for p in parts])


def money(amount: Column) -> Column:
    """``$1,234.50``. Rounds half up first: format_number alone rounds half even."""
    return F.concat(F.lit("$"), F.format_number(F.round(amount, 2), 2))


def fixed(value: Column, digits: int) -> Column:
    """Number as text with exactly ``digits`` decimals and no grouping."""
    return F.round(value, digits).cast(f"decimal(38,{digits})").cast("string")


def percent(value: Column, digits: int = 2) -> Column:
    """``12.50%``; NULL stays NULL."""
    return F.concat(fixed(value, digits), F.lit("%"))
