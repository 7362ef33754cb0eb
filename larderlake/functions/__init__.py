from larderlake.functions.columns import (
    DATE_TEXT,
    conform,
    date_key,
    money,
    ratio,
    stock_status,
    total,
    typed,
)
from larderlake.functions.keys import packed, surrogate_key, unpacked

__all__ = [
    "DATE_TEXT",
    "conform",
    "date_key",
    "money",
    "packed",
    "ratio",
    "stock_status",
    "surrogate_key",
    "total",
    "typed",
    "unpacked",
]
