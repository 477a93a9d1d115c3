"""The reporting questions the star schema is shaped for.

All three read the fact once through broadcast star joins, aggregate with
partial (map-side) aggregation and shuffle only one row per group per task.
Averages are ``double(sum) / count``: the decimal sum is exact, and the single
division makes the value independent of the engine's decimal-average rules.
Sums are taken over decimal(28,2) inputs, so they cannot overflow at any
realistic row count (decimal(38,2) result).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.dimensions import Dimensions
from txlake.operators.fact import YEAR_COLUMN
from txlake.operators.star import star_join

WIDE_PRICE = "decimal(28,2)"
WIDE_SURFACE = "decimal(28,1)"


def _mean(total: Column, n: Column) -> Column:
    """double(sum) / count; null (not an ANSI error) when nothing was counted."""
    return F.try_divide(total.cast("double"), n)


def avg_price_by_region_type_quarter(fact: DataFrame, dims: Dimensions, year: int | None = None) -> DataFrame:
    """Average price by region, property type and calendar quarter; with ``year``
    of that year only, which on a fact stored by year reads that year alone."""
    if year is not None:
        if YEAR_COLUMN in fact.columns:
            fact = fact.where(F.col(YEAR_COLUMN) == year)
        dims = replace(dims, date=replace(dims.date, df=dims.date.df.where(F.col("year") == year)))
        fact = fact.join(dims.date.for_join().select("date_id"), "date_id", "left_semi")
    price = F.col("price_mad").cast(WIDE_PRICE)
    return (
        star_join(fact, dims, use=("date", "property_type", "location"))
        .groupBy(
            "region",
            F.col("property_type_name").alias("property_type"),
            "year",
            "quarter",
        )
        .agg(
            F.count(F.lit(1)).alias("n_transactions"),
            F.sum(price).alias("sum_price_mad"),
            _mean(F.sum(price), F.count(price)).alias("avg_price_mad"),
        )
    )


def status_breakdown(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Transactions, total and average price per registration status."""
    price = F.col("price_mad").cast(WIDE_PRICE)
    return (
        star_join(fact, dims, use=("registration_status",))
        .groupBy("status_name")
        .agg(
            F.count(F.lit(1)).alias("n_transactions"),
            F.sum(price).alias("sum_price_mad"),
            _mean(F.sum(price), F.count(price)).alias("avg_price_mad"),
        )
    )


def null_aware_measures(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Surface measures by property type: nulls are excluded, never imputed.

    ``n_rows`` counts every fact, ``n_surface`` only facts with a surface; the
    sum and average ignore the missing surfaces.
    """
    surface = F.col("surface_m2").cast(WIDE_SURFACE)
    return (
        star_join(fact, dims, use=("property_type",))
        .groupBy(F.col("property_type_name").alias("property_type"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(surface).alias("n_surface"),
            (F.count(F.lit(1)) - F.count(surface)).alias("n_surface_missing"),
            F.sum(surface).alias("sum_surface_m2"),
            _mean(F.sum(surface), F.count(surface)).alias("avg_surface_m2"),
        )
    )
