"""The cleaned transaction table: deduplicated, typed, nulls kept.

Cleaning is row-local, so it runs before the dedup shuffle: the shuffled rows
carry a date and two decimals instead of their text forms.  Choosing one row
per id from cleaned or from raw values is the same operation when copies are
identical, which is the documented defect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from txlake.functions import city_clean, date_parse, price_clean, surface_clean
from txlake.operators.dedup import dedup_by_key


def clean_columns(raw: DataFrame) -> DataFrame:
    """Apply the four cleaning rules in one projection (no dedup)."""
    return raw.select(
        "transaction_id",
        "listing_id",
        "property_type",
        "region",
        city_clean("city").alias("city"),
        surface_clean("surface_m2").alias("surface_m2"),
        price_clean("price_mad").alias("price_mad"),
        "registration_status",
        "source_office",
        date_parse("transaction_date").alias("transaction_date"),
    )


def clean_transactions(raw: DataFrame, keep: str = "min", dedup_strategy: str = "shuffle") -> DataFrame:
    """Raw export -> one typed row per transaction_id."""
    return dedup_by_key(clean_columns(raw), ["transaction_id"], keep=keep, strategy=dedup_strategy)

