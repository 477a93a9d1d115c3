"""Calendar attributes of a date, as stored in the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(c: Column, week_start: str = "monday") -> Column:
    """1..7.  ``monday``: ISO numbering (Monday = 1, Sunday = 7), the meaning the
    warehouse column documents.  ``sunday``: Spark ``dayofweek`` (Sunday = 1)."""
    if week_start == "monday":
        return F.weekday(c) + F.lit(1)
    if week_start == "sunday":
        return F.dayofweek(c)
    raise ValueError(f"week_start must be 'monday' or 'sunday', not {week_start!r}")


def date_parts(c: Column, week_start: str = "monday") -> dict[str, Column]:
    """year, quarter, month, day_of_week as int columns."""
    return {
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "day_of_week": day_of_week(c, week_start).cast("int"),
    }
