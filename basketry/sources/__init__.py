"""Sources: text files of the reference's formats and basket views over parquet."""

from basketry.sources.tables import (
    date_customer_brand,
    day_user_event,
    event_lines,
    order_brand,
    part_supplier,
    table,
)
from basketry.sources.text import case_projection, read_lines, read_pairs, read_retail, retail_pairs

__all__ = [
    "case_projection",
    "date_customer_brand",
    "day_user_event",
    "event_lines",
    "order_brand",
    "part_supplier",
    "read_lines",
    "read_pairs",
    "read_retail",
    "retail_pairs",
    "table",
]
