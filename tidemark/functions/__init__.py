"""Column expressions shared by the operators."""

from tidemark.functions.compare import differs
from tidemark.functions.stock import adjusted_stock, stock_status
from tidemark.functions.transforms import (
    bucket_of,
    in_month_range,
    in_months,
    month_ordinal,
    ntz,
    part_code,
    part_value,
)

__all__ = [
    "adjusted_stock",
    "bucket_of",
    "differs",
    "in_month_range",
    "in_months",
    "month_ordinal",
    "ntz",
    "part_code",
    "part_value",
    "stock_status",
]
