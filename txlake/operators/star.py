"""Star joins: the fact with its descriptive attributes.

Every dimension is joined by its integer key with a size-checked broadcast, so
the fact is scanned once and never shuffled for the join.  Left joins keep
facts whose key did not resolve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.operators.dimensions import Dimensions
from txlake.operators.joins import DEFAULT_BROADCAST_ROWS


def star_join(
    fact: DataFrame,
    dims: Dimensions,
    use: tuple[str, ...] = ("date", "property_type", "location", "registration_status"),
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Fact left-joined to the named dimensions on their surrogate keys."""
    out = fact
    if "date" in use:
        out = out.join(dims.date.for_join(max_broadcast_rows), "date_id", "left")
    if "property_type" in use:
        out = out.join(dims.property_type.for_join(max_broadcast_rows), "property_type_id", "left")
    if "location" in use:
        out = out.join(dims.location.for_join(max_broadcast_rows), "location_id", "left")
    if "registration_status" in use:
        out = out.join(dims.registration_status.for_join(max_broadcast_rows), "registration_status_id", "left")
    return out


def flatten(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """The star joined back to the clean table's shape (the round-trip check)."""
    return star_join(fact, dims).select(
        "transaction_id",
        "listing_id",
        F.col("property_type_name").alias("property_type"),
        "region",
        "city",
        "surface_m2",
        "price_mad",
        F.col("status_name").alias("registration_status"),
        "source_office",
        F.col("full_date").alias("transaction_date"),
    )
