"""Calendar months and elapsed time.

Everything works alike on TIMESTAMP and TIMESTAMP_NTZ: differences are taken as
day-time intervals, never through a cast that depends on the session zone.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def moment(value: datetime.datetime, kind: T.DataType) -> Column:
    """Literal instant of a timestamp type, read in the session time zone."""
    return F.lit(value.isoformat(sep=" ")).cast(kind)


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def month_distance(start: Column, end: Column) -> Column:
    """Calendar months from ``start`` to ``end``."""
    return (
        (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
    ).cast("int")


def whole_days(earlier: Column, later: Column) -> Column:
    """Completed days between two instants, truncated toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def interval_micros(earlier: Column, later: Column) -> Column:
    """Microseconds between two instants."""
    gap = later - earlier

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), gap)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")
