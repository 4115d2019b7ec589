"""Ratios. Sums stay exact decimals; the one division is done in double.

Before the division both sides are scaled by 10,000, which turns amounts with up
to four decimals into whole numbers. Those are exact as doubles, so the quotient
is rounded once and a tie such as 46.875 stays a tie.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.labels import CANCELLED


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; NULL for a zero denominator."""
    scale = F.lit(Decimal(10_000))
    whole = (denominator * scale).cast("double")
    return (numerator * scale).cast("double") / F.nullif(whole, F.lit(0.0))


def cents(df: DataFrame, name: str) -> Column:
    """An amount column as whole cents, for sums over lines.

    Sums of 64-bit integers stay in generated code; decimal sums do not. They
    hold 92 quadrillion currency units, and Spark raises an error beyond that.
    """
    kind = df.schema[name].dataType
    if not isinstance(kind, T.DecimalType) or kind.scale > 2:
        raise TypeError(f"{name} must be a decimal with at most two decimals, not {kind}")
    return (F.col(name) * 100).cast("bigint")


def amount(whole_cents: Column) -> Column:
    """Whole cents as an exact decimal amount."""
    return (whole_cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Share in percent, rounded half up."""
    return F.round(ratio(numerator * 100, denominator), digits)


def pct_of_cents(part: Column, whole: Column, digits: int = 2) -> Column:
    """``pct`` for whole numbers, which need no scaling; for use on every line."""
    return F.round(
        (part * 100).cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits
    )


def not_cancelled(status: str = "order_status") -> Column:
    """Row filter of the revenue reports; an unknown (NULL) status fails it."""
    return F.col(status) != CANCELLED
