"""Column expressions: cleaning rules and calendar attributes."""

from txlake.functions.cleaning import (
    RAW_DATE_FORMAT,
    city_clean,
    date_parse,
    empty_to_null,
    price_clean,
    strip_thousands,
    surface_clean,
)
from txlake.functions.dates import date_parts, day_of_week

__all__ = [
    "RAW_DATE_FORMAT",
    "city_clean",
    "date_parse",
    "date_parts",
    "day_of_week",
    "empty_to_null",
    "price_clean",
    "strip_thousands",
    "surface_clean",
]
