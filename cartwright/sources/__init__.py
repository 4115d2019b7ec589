from cartwright.sources.csv_files import load_csv, load_generated_column, write_csv
from cartwright.sources.layouts import UnevenBuckets, write_bucketed, write_orders_by_customer, write_orders_by_status
from cartwright.sources.schemas import DEFAULTS, SCHEMAS
from cartwright.sources.star_tables import StarTables

__all__ = [
    "DEFAULTS",
    "SCHEMAS",
    "StarTables",
    "UnevenBuckets",
    "load_csv",
    "load_generated_column",
    "write_bucketed",
    "write_csv",
    "write_orders_by_customer",
    "write_orders_by_status",
]
