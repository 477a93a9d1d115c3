"""Registered queries of later loads, histories and stateful streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.operators import RULES, clean_transactions, flatten, star_join
from txlake.operators.cube import add_load, exact_quantiles, price_cells, price_cube, stored_cells
from txlake.operators.drift import drift, drift_bounds, load_profile, transaction_columns
from txlake.operators.history import as_of_join, hot_keys, validity_intervals
from txlake.operators.lake_dedup import dedup_against_lake, store_by_id
from txlake.operators.verdicts import compile_rules, rule_verdicts
from txlake.plans.batch import build_star, load_star, run_batch
from txlake.plans.incremental import extend_dimensions, reload_window
from txlake.schemas import EVENT_COLUMNS
from txlake.session import shared_dir
from txlake.sources import (
    event_messages,
    materialize,
    raw_transactions,
    raw_transactions_dirty,
    read_table,
    write_csv,
    write_table,
)
from txlake.sources.fixtures import padded, table
from txlake.sources.streams import text_stream
from txlake.streaming.star import load_batch, run_available_to_star, stream_facts
from txlake.streaming.stateful import dedup_events, drain, late_rows, windowed_by_region


def _key(listing: str = "listing_id", prefix: int = 3) -> Column:
    return F.substring(listing, prefix + 1, 20).cast("long")


# --- loads ---------------------------------------------------------------------


def corrected_1997(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corrected export of 1997: new prices, rows that were withdrawn, rows that
    move to 1998, and rows of 1996 that belong to 1997."""
    raw = raw_transactions(spark, sf_dir)
    k, year = _key(), F.substring("transaction_date", 1, 4)
    rows = raw.where(((year == "1997") & (k % 19 != 0)) | ((year == "1996") & (k % 17 == 0)))
    date = F.when(year == "1996", "1997-12-31").when(k % 13 == 0, "1998-01-15").otherwise(F.col("transaction_date"))
    price = F.when(k % 7 == 0, "1,000,000").otherwise(F.col("price_mad"))
    return rows.select(*[{"transaction_date": date, "price_mad": price}.get(c, F.col(c)).alias(c) for c in raw.columns])


def fact_reload_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load, a reload of 1997 with corrected rows, and the same reload again;
    the fact with its natural keys."""
    csv, lake = shared_dir(spark, "reload_csv"), shared_dir(spark, "reload_lake")
    write_csv(raw_transactions(spark, sf_dir), csv)
    run_batch(spark, csv, lake)
    corrected = materialize(corrected_1997(spark, sf_dir), "corrected_export")
    for _ in range(2):
        reload_window(spark, lake, corrected, [1997])
    star = load_star(spark, lake)
    return flatten(star.fact, star.dims)


FIRST_REGIONS = ["AMERICA", "EUROPE"]


def dim_location_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations after a load of two regions and a load of all: the first keys stay."""
    root = shared_dir(spark, "two_loads")
    raw = raw_transactions(spark, sf_dir)
    extend_dimensions(spark, root, clean_transactions(raw.where(F.col("region").isin(FIRST_REGIONS))))
    return extend_dimensions(spark, root, clean_transactions(raw)).location.df


BUCKETS = 16


def dedup_against_lake_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake holds two thirds of the listings; a load of every second one arrives."""
    path = shared_dir(spark, "lake_by_id")
    clean = clean_transactions(raw_transactions(spark, sf_dir))
    store_by_id(clean.where(_key() % 3 != 0), path, "transaction_id", BUCKETS)
    load = materialize(clean.where(_key() % 2 == 0), "second_load")
    return dedup_against_lake(load, path, "transaction_id", BUCKETS)


# --- history -------------------------------------------------------------------


def listing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes of listings: one a line item, at its ship date."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    status = (
        F.when(F.col("l_returnflag") == "A", "in_progress").when(F.col("l_returnflag") == "N", "registered").otherwise("disputed")
    )
    return items.select(
        padded("LST", F.col("l_orderkey")).alias("listing_id"),
        F.col("l_shipdate").cast("date").alias("changed_on"),
        status.alias("status"),
    )


def listing_status_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity_intervals(listing_changes(spark, sf_dir), ["listing_id"], "changed_on", ["status"])


def listing_status_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of each sold listing 60 days after the sale."""
    orders = table(spark, sf_dir, "orders").select(
        padded("LST", F.col("o_orderkey")).alias("listing_id"),
        F.date_add(F.col("o_orderdate").cast("date"), 60).alias("as_of"),
    )
    changes, keys = listing_changes(spark, sf_dir), ["listing_id"]
    # a key has no more intervals than changes: counted once for both steps
    hot = hot_keys(keys, changes, orders)
    intervals = validity_intervals(changes, keys, "changed_on", ["status"], hot=hot)
    return as_of_join(orders, intervals, keys, "as_of", ["status"], hot=hot)


# --- summaries and rules ---------------------------------------------------------


def _cells_of_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the even and the odd listings, added one after the other; the second
    load is added twice."""
    star = build_star(raw_transactions(spark, sf_dir))
    path = shared_dir(spark, "cells")
    for load, odd in (("1", 0), ("2", 1), ("2", 1)):
        add_load(price_cells(star.fact.where(_key() % 2 == odd), star.dims), path, load)
    return stored_cells(spark, path)


def price_cube_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_cube(_cells_of_two_loads(spark, sf_dir))


def price_median_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact lower median, quartiles and 99th percentile of the price by type."""
    star = build_star(raw_transactions(spark, sf_dir))
    priced = star_join(star.fact, star.dims, use=("property_type",)).select(
        F.col("property_type_name").alias("property_type"), (F.col("price_mad") * 100).cast("long").alias("price_cents")
    )
    return exact_quantiles(priced, ["property_type"], "price_cents", [(1, 4), (1, 2), (3, 4), (99, 100)])


#: Rules beyond the warehouse's own, as data: (table, kind, columns, param).
MORE_RULES = [
    ("fact_transactions", "check", "price_mad", "price_mad >= 20000"),
    ("fact_transactions", "check", "surface_m2", "surface_m2 between 40 and 1200"),
    ("fact_transactions", "unique", "listing_id", None),
    ("dim_location", "one_of", "region", "AFRICA|AMERICA|ASIA|EUROPE"),
]


def rule_verdicts_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = build_star(raw_transactions_dirty(spark, sf_dir))
    return rule_verdicts(star.fact, star.dims, RULES + compile_rules(MORE_RULES))


def load_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty export against the clean one, by stored profiles."""
    columns, path = transaction_columns(), shared_dir(spark, "profiles")
    clean = clean_transactions(raw_transactions(spark, sf_dir))
    write_table(drift_bounds(clean, columns), f"{path}/bounds")
    bounds = read_table(spark, f"{path}/bounds")
    write_table(load_profile(clean, columns, bounds), f"{path}/first")
    write_table(load_profile(clean_transactions(raw_transactions_dirty(spark, sf_dir)), columns, bounds), f"{path}/second")
    return drift(read_table(spark, f"{path}/first"), read_table(spark, f"{path}/second"))


# --- streams -------------------------------------------------------------------


def _event(prefix: int = 9) -> Column:
    """Number of the event in a message (``"transaction_id":"STREAM..."``)."""
    return F.regexp_extract("value", r"STREAM(\d+)", 1).cast("long")


def stream_to_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land in the star in two runs; the first micro-batch is replayed."""
    source, lake, checkpoint = (shared_dir(spark, f"star_{x}") for x in ("src", "lake", "ckpt"))
    messages = event_messages(spark, sf_dir)
    for half in (0, 1):
        part = messages.where(_event() % 2 == half)
        part.write.mode("append").text(source)
        run_available_to_star(text_stream(spark, source), lake, checkpoint)
    load_batch(messages.where(_event() % 2 == 0), 0, lake)
    star = load_star(spark, lake, fact=stream_facts(spark, lake).drop("batch_id"))
    return flatten(star.fact, star.dims)


DELAY = "2 days"


def _repeated_stream(spark: SparkSession, sf_dir: str):
    """Two arrivals: the first three fifths of the events but every 50th, some twice;
    then everything that is left and every third event again."""
    messages = event_messages(spark, sf_dir)
    n = table(spark, sf_dir, "events").count()
    e = _event()
    early = (e < n * 3 // 5) & (e % 50 != 7)
    source, sink, checkpoint = (shared_dir(spark, f"dedup_{x}") for x in ("src", "sink", "ckpt"))
    first = messages.where(early)
    first.unionByName(first.where(e % 5 == 0)).write.mode("append").text(source)
    one = drain(dedup_events(text_stream(spark, source), DELAY), sink, checkpoint)
    messages.where(~early).unionByName(messages.where(e % 3 == 0)).write.mode("append").text(source)
    two = drain(dedup_events(text_stream(spark, source), DELAY), sink, checkpoint)
    return spark.read.parquet(sink), late_rows(one) + late_rows(two)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, without those that came after the watermark."""
    return _repeated_stream(spark, sf_dir)[0].select(*EVENT_COLUMNS)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed, and rows that came too late."""
    landed, late = _repeated_stream(spark, sf_dir)
    return landed.agg(F.count(F.lit(1)).alias("n_landed")).withColumn("n_late", F.lit(late).cast("long"))


def stream_hourly_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows in append mode over two arrivals; those that the watermark
    (one hour behind the newest event) has passed."""
    messages = event_messages(spark, sf_dir)
    half = table(spark, sf_dir, "events").count() // 2
    source, sink, checkpoint = (shared_dir(spark, f"hourly_{x}") for x in ("src", "sink", "ckpt"))
    for part in (_event() < half, _event() >= half):
        messages.where(part).write.mode("append").text(source)
        drain(windowed_by_region(text_stream(spark, source)), sink, checkpoint)
    return spark.read.parquet(sink)


QUERIES = {
    "fact_reload_window": fact_reload_window,
    "dim_location_second_load": dim_location_second_load,
    "dedup_against_lake": dedup_against_lake_q,
    "listing_status_intervals": listing_status_intervals,
    "listing_status_as_of": listing_status_as_of,
    "price_cube_incremental": price_cube_incremental,
    "price_median_by_type": price_median_by_type,
    "rule_verdicts_dirty": rule_verdicts_dirty,
    "load_drift": load_drift,
    "stream_to_star": stream_to_star,
    "stream_dedup": stream_dedup,
    "stream_late_rows": stream_late_rows,
    "stream_hourly_by_region": stream_hourly_by_region,
}
