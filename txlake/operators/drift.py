"""Drift between loads: stored histograms and the distance of two of them.

A profile has one row for each column and bin.  Numbers fall into bins between exact
quantiles of the first load (so its bins are about equally full); the bounds are stored
with the profile and serve all later loads.  Text columns have a bin for each value.
Nulls are a bin of their own.  A profile is one pre-aggregated pass, and two loads are
compared by their profiles alone, without reading the loads again.

The distance of a column is the total variation: the share of rows that would have to
change bins, 0 (alike) to 1 (nothing in common), in whole numbers up to one division.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.cube import exact_quantiles

DECILES = [(i, 10) for i in range(1, 10)]


@dataclass
class DriftColumns:
    """Columns to watch: numbers (whole-number expressions by name) and text."""

    numbers: dict[str, Column]
    texts: list[str]


def transaction_columns() -> DriftColumns:
    return DriftColumns(
        numbers={
            "price_mad": (F.col("price_mad") * 100).cast("long"),
            "surface_m2": (F.col("surface_m2") * 10).cast("long"),
            "transaction_date": F.unix_date("transaction_date").cast("long"),
        },
        texts=["property_type", "region", "city", "registration_status", "source_office"],
    )


def _numbers(df: DataFrame, columns: DriftColumns) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), c.alias("v")) for n, c in columns.numbers.items()])
    return df.select(F.explode(pairs).alias("p")).select("p.column_name", "p.v")


def drift_bounds(df: DataFrame, columns: DriftColumns) -> DataFrame:
    """(column_name, bounds): the distinct deciles of each number column, ascending."""
    found = exact_quantiles(_numbers(df, columns), ["column_name"], "v", DECILES)
    return found.groupBy("column_name").agg(F.sort_array(F.collect_set("v")).alias("bounds"))


def load_profile(df: DataFrame, columns: DriftColumns, bounds: DataFrame) -> DataFrame:
    """(column_name, bin, n): bins of numbers are ``b0`` (up to the first bound) to
    ``bK`` (above the last), of text its value; the bin of nulls is null.  ``bounds`` is
    one row for each column and broadcast."""
    below = F.concat(F.lit("b"), F.size(F.filter("bounds", lambda b: b < F.col("v"))).cast("string"))
    # without a value in the first load there is one bin
    binned = F.when(F.col("v").isNotNull(), F.coalesce(below, F.lit("b0")))
    numbers = _numbers(df, columns).join(F.broadcast(bounds), "column_name", "left").select("column_name", binned.alias("bin"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("bin")) for c in columns.texts])
    texts = df.select(F.explode(pairs).alias("p")).select("p.column_name", "p.bin")
    return numbers.unionByName(texts).groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))


def drift(first: DataFrame, second: DataFrame) -> DataFrame:
    """(column_name, n_first, n_second, distance) from two profiles.  The distance is
    null where a load is empty."""
    both = (
        first.select("column_name", "bin", F.col("n").alias("a"), F.lit(0).cast("long").alias("b"))
        .unionByName(second.select("column_name", "bin", F.lit(0).cast("long").alias("a"), F.col("n").alias("b")))
        .groupBy("column_name", "bin")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    totals = both.groupBy("column_name").agg(F.sum("a").alias("n_first"), F.sum("b").alias("n_second"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    apart = F.sum(F.abs(wide("a") * wide("n_second") - wide("b") * wide("n_first"))).alias("apart")
    # one row for each column
    sums = both.join(totals, "column_name").groupBy("column_name", "n_first", "n_second").agg(apart)
    scale = wide("n_first").cast("double") * wide("n_second").cast("double") * 2
    distance = F.try_divide(F.col("apart").cast("double"), scale)
    return sums.select("column_name", "n_first", "n_second", distance.alias("distance"))
