from cartwright.functions.dates import (
    interval_micros,
    moment,
    month_distance,
    month_start,
    whole_days,
)
from cartwright.functions.labels import CANCELLED
from cartwright.functions.numbers import amount, cents, not_cancelled, pct, pct_of_cents, ratio
from cartwright.functions.text import fixed, join_text, money, percent

__all__ = [
    "CANCELLED",
    "amount",
    "cents",
    "fixed",
    "interval_micros",
    "join_text",
    "moment",
    "money",
    "month_distance",
    "month_start",
    "not_cancelled",
    "pct",
    "pct_of_cents",
    "percent",
    "ratio",
    "whole_days",
]
