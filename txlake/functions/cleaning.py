"""Column rules that repair the four documented defects of the raw export.

Each rule is a plain Column expression built from Spark built-ins, so it stays
inside whole-stage codegen and works the same on batch and streaming frames.
``try_cast`` / ``try_to_date`` give the null-on-bad-text behaviour of a
non-ANSI cast without switching ANSI mode off for the whole session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlake.schemas import PRICE_TYPE, SURFACE_TYPE

ColumnOrName = Column | str

# Fixed value: the date layout of the raw export.
RAW_DATE_FORMAT = "yyyy-MM-dd"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_thousands(c: ColumnOrName) -> Column:
    """Remove every comma ("1,250,000" -> "1250000"); plain numbers unchanged.

    ``translate`` deletes the character without compiling a regex per task.
    """
    return F.translate(_col(c), ",", "")


def empty_to_null(c: ColumnOrName) -> Column:
    """Exactly the empty string becomes null; a blank " " is kept."""
    return F.nullif(_col(c), F.lit(""))


def price_clean(c: ColumnOrName = "price_mad") -> Column:
    """Text price (plain or thousands-separated) -> decimal(12,2); bad text -> null."""
    return strip_thousands(c).try_cast(PRICE_TYPE)


def surface_clean(c: ColumnOrName = "surface_m2") -> Column:
    """Empty or missing surface stays null (never imputed) -> decimal(10,1)."""
    return empty_to_null(c).try_cast(SURFACE_TYPE)


def city_clean(c: ColumnOrName = "city") -> Column:
    """Missing city stays null (never a placeholder such as 'Unknown')."""
    return empty_to_null(c)


def date_parse(c: ColumnOrName = "transaction_date", fmt: str = RAW_DATE_FORMAT) -> Column:
    """Strict date parse; impossible or mis-formatted dates -> null."""
    return F.try_to_date(_col(c), fmt)
