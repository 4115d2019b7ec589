from cartwright.streaming.inventory import inventory_stream, stock_levels
from cartwright.streaming.monthly import (
    monthly_buyers_stream,
    monthly_stream,
    monthly_totals,
    read_monthly_buyers,
)

__all__ = [
    "inventory_stream", "monthly_buyers_stream", "monthly_stream", "monthly_totals", "read_monthly_buyers", "stock_levels",
]
