"""Fact build: resolve the four foreign keys of every clean transaction.

Left joins from the clean table (the large, streamed side) to each dimension,
so no transaction is dropped: an unresolved key stays null and is reported by
the constraint report.  Dimensions are broadcast behind their counted size, so
the fact is never shuffled; the location key uses null-safe equality on city,
which Catalyst plans as a hash join on ``(region, coalesce(city, ''),
isnull(city))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.operators.dimensions import Dimensions
from txlake.operators.joins import DEFAULT_BROADCAST_ROWS
from txlake.schemas import FACT_COLUMNS, FACT_NOT_NULL


#: Column by which a stored fact is laid out, so reports on a year read that year.
YEAR_COLUMN = "transaction_year"


def broken_rules(fact: DataFrame) -> DataFrame:
    """``fact`` with the columns of its broken NOT NULL rules in ``broken_rules``."""
    broken = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in FACT_NOT_NULL]))
    return fact.withColumn("broken_rules", F.array_join(broken, ","))


def split_rejects(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects): rows that break a NOT NULL rule of the warehouse go to
    the rejects, with the broken rules' columns in ``broken_rules``."""
    accepted = fact.where(" and ".join(f"{c} is not null" for c in FACT_NOT_NULL))
    return accepted, broken_rules(fact).where(F.col("broken_rules") != "")


def build_fact(
    clean: DataFrame,
    dims: Dimensions,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    with_year: bool = False,
    join_hint: str | None = None,
) -> DataFrame:
    """``with_year`` adds ``transaction_year``; ``join_hint`` (``merge``) forces
    that join for every dimension."""

    def side(df: DataFrame) -> DataFrame:
        return df.hint(join_hint) if join_hint else df

    d_date = dims.date.for_join(max_broadcast_rows).select("date_id", F.col("full_date").alias("_d_date"))
    d_type = dims.property_type.for_join(max_broadcast_rows).select(
        "property_type_id", F.col("property_type_name").alias("_d_type")
    )
    d_loc = dims.location.for_join(max_broadcast_rows).select(
        "location_id", F.col("region").alias("_d_region"), F.col("city").alias("_d_city")
    )
    d_status = dims.registration_status.for_join(max_broadcast_rows).select(
        "registration_status_id", F.col("status_name").alias("_d_status")
    )
    return (
        clean.join(side(d_date), F.col("transaction_date") == F.col("_d_date"), "left")
        .join(side(d_type), F.col("property_type") == F.col("_d_type"), "left")
        .join(
            side(d_loc),
            (F.col("region") == F.col("_d_region")) & F.col("city").eqNullSafe(F.col("_d_city")),
            "left",
        )
        .join(side(d_status), F.col("registration_status") == F.col("_d_status"), "left")
        .select(*FACT_COLUMNS, *[F.year("transaction_date").alias(YEAR_COLUMN)] * with_year)
    )
